"""Alignment of two tokenizers over the same texts, and corpus-wide counts of linked ids.

Tokenizer A is a byte-level BPE of the tokenizers library and reads a space and the text;
tokenizer B is a SentencePiece BPE with byte fallback and reads the text, before which
it puts its own space. Both cut before a single space between two visible characters,
whatever stands around it, so texts are cut there and each distinct word is coded once
per task while it is remembered.

The spans that A's library gives are coarse cuts: they are in characters, so several
tokens of one character share a span. Between two cuts that the spans tell apart, and
for all of B, ends follow from the tokens' decoded bytes. Two tokens are linked where their byte ranges overlap.

Counts of linked ids grow with the vocabularies only, but looking them up for every
document would shuffle every link. So documents are worked on in slices of a few
megabytes; each slice has a dictionary of its distinct linked pairs, and only
dictionaries meet the counts. A slice's dictionary then comes back to its documents.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.batches import column, gather, slices, strings
from lakewright.llm.tables import settled

#: A space between visible characters, at which both tokenizers begin a new token.
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"
#: Bytes of text in a slice, distinct words that a task remembers, and words that are coded together.
BYTES, REMEMBERED, TOGETHER = 1_000_000, 300_000, 500
#: A pair of ids as one number: A's id times this plus B's id.
PAIR = 1 << 31


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: visible ones themselves, others from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Surfaces:
    """The bytes of each id of a vocabulary."""

    def __init__(self, surfaces: list[bytes]):
        self.lengths = np.array([len(s) for s in surfaces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(surfaces), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[gather(self.starts[ids], self.lengths[ids])]


def refined(lengths: np.ndarray, coarse: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The byte end of each token in its word, from ``coarse`` ends (-1: not told) and decoded ``lengths``.

    ``first`` are the places of each word's first token. An end that is not told is the last
    told one plus the bytes decoded since. A word whose told ends contradict its decoded bytes
    goes by the bytes alone.
    """
    total = np.concatenate(([0], np.cumsum(lengths)))
    word = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(lengths))))
    decoded = total[1:] - total[first][word]
    told = coarse >= 0
    last = np.maximum.accumulate(np.where(told, np.arange(len(lengths)), -1))
    ends = np.where(last >= first[word], coarse[last] + decoded - decoded[last], decoded)
    contradicted = np.zeros(len(first), bool)
    contradicted[word[told & (coarse != decoded)]] = True
    return np.where(contradicted[word], decoded, ends)


class _Numbered(dict):
    """Gives each new key the next number."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Aligner:
    """Both tokenizers and the words that were aligned last."""

    def __init__(self, tokenizer: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer)
        self.a.encode_special_tokens = True
        told, of = json.loads(tokenizer), byte_of_symbol()
        if told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"] or told["normalizer"]:
            raise ValueError("tokenizer A has to be byte-level, without normaliser and prefix space")
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        added = {t["id"]: t["content"].encode() for t in told["added_tokens"]}
        surfaces = [b""] * (max(vocabulary.values()) + 1)
        for symbol, i in vocabulary.items():
            surfaces[i] = added[i] if i in added else bytes(of[c] for c in symbol)
        self.a_bytes = _Surfaces(surfaces)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = _Surfaces([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in pieces])
        self.decimals = _Surfaces([str(i).encode() for i in range(max(len(surfaces), len(pieces)))])
        self.forget()

    def forget(self) -> None:
        """Word 0 is none and has no tokens."""
        self.index = _Numbered({"": 0})
        self.bad = np.array([False])
        self.counts = np.zeros((1, 4), np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.tokens: tuple[np.ndarray, ...] = tuple(np.zeros(0, np.int64) for _ in range(4))
        # the ids of all groups in the order in which they are spelled, and the sign after each
        self.spelled, self.signs = np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def _a(self, texts: list[str], sizes: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A's ids, ids per text, and byte ends in a space and the text, from the bytes of all ``chars`` of them."""
        coded = self.a.encode_batch([f" {t}" for t in texts], add_special_tokens=False)
        spans = [np.array(e.offsets, np.int64).reshape(-1, 2) for e in coded]
        counts = np.fromiter(map(len, spans), np.int64, len(spans))
        ids, spans = np.concatenate([np.array(e.ids, np.int64) for e in coded]), np.concatenate(spans)
        first = np.cumsum(counts) - counts
        byte_end = np.concatenate(([0], np.cumsum(sizes)))
        start = np.repeat(np.cumsum(chars) - chars, counts)
        coarse = byte_end[start + spans[:, 1]] - byte_end[start]
        # an end is told if the next token of the text begins there and not inside the same character
        inside = np.zeros(len(ids), bool)
        inside[:-1] = spans[1:, 0] < spans[:-1, 1]
        inside[first[1:] - 1] = False
        return ids, counts, refined(self.a_bytes.lengths[ids], np.where(inside, -1, coarse), first)

    def _b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """B's ids, ids per text, and byte ends in a space and the text.

        Spans are not asked for: they cost more than the coding, and where tokens spell their
        text, as all that are used do, its ends are those of their decoded bytes.
        """
        coded = self.b.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter(chain.from_iterable(coded), np.int64)
        total = np.concatenate(([0], np.cumsum(self.b_bytes.lengths[ids])))
        return ids, counts, total[1:] - np.repeat(total[np.cumsum(counts) - counts], counts)

    def learn(self, words: list[str]) -> None:
        """Align ``words``, none of them known.

        They are coded many at a time, with a single space between them, at which both
        tokenizers part if it stands between visible characters; so a word that begins or
        ends with white space (the first and last of a text) is coded alone. If the tokens
        of such a text do not spell it, its words are coded one by one, and those that are
        not spelled then are bad.
        """
        groups: list[list[str]] = []
        for visible, run in groupby(words, lambda w: not (w[0].isspace() or w[-1].isspace())):
            run, size = list(run), TOGETHER if visible else 1
            groups += [run[k : k + size] for k in range(0, len(run), size)]
        while groups:
            unclear = self._learn([" ".join(g) for g in groups], groups)
            if unclear is None:
                return
            # keep the words' order: all come again, those of unclear texts alone
            groups = [part for g, bad in zip(groups, unclear) for part in ([[w] for w in g] if bad else [g])]

    def _learn(self, texts: list[str], groups: list[list[str]]) -> np.ndarray | None:
        codes = np.frombuffer("".join(f" {t}" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF).astype(np.int64)
        flat = np.frombuffer("".join(f" {t}" for t in texts).encode("utf-8", "surrogatepass"), np.uint8)
        chars = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        byte_end = np.concatenate(([0], np.cumsum(sizes)))
        text_end = byte_end[np.cumsum(chars)]
        text_size = np.diff(text_end, prepend=0)
        sides, bad = [], np.zeros(len(texts), bool)
        for coded, surfaces in ((self._a(texts, sizes, chars), self.a_bytes), (self._b(texts), self.b_bytes)):
            ids, counts, ends = coded
            text = np.repeat(np.arange(len(texts)), counts)
            bad |= np.bincount(text, surfaces.lengths[ids], len(texts)).astype(np.int64) != text_size
            sides.append((ids, ends, text, surfaces))
        for ids, _, text, surfaces in sides:
            right = np.repeat(~bad, text_size)
            wrong = np.flatnonzero(surfaces.of(ids[~bad[text]]) != flat[right])
            bad[np.searchsorted(text_end, np.flatnonzero(right)[wrong], side="right")] = True
        many = np.array([len(g) > 1 for g in groups])
        if (bad & many).any():
            return bad & many
        words = [w for g in groups for w in g]
        of_text = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        word_end = byte_end[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]
        word_start = np.concatenate(([0], word_end[:-1]))
        text_start = text_end - text_size
        (a, a_end), (b, b_end) = ((ids[~bad[text]], (ends + text_start[text])[~bad[text]]) for ids, ends, text, _ in sides)
        a_word, b_word = np.searchsorted(word_end, a_end), np.searchsorted(word_end, b_end)
        n, a_start = len(words), a_end - self.a_bytes.lengths[a]
        low, high = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_end, a_end, side="left")
        linked = high - low + 1
        self.pairs = np.concatenate((self.pairs, np.repeat(a, linked) * PAIR + b[gather(low, linked)]))
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        counts = np.stack(
            [
                np.bincount(a_word, minlength=n), np.bincount(b_word, minlength=n), np.bincount(np.searchsorted(word_end, cuts), minlength=n),
                np.bincount(a_word, linked, n),
            ],
            axis=1,
        )
        self.counts = np.concatenate((self.counts, counts.astype(np.int64)))
        self.bad = np.concatenate((self.bad, bad[of_text]))
        self.tokens = tuple(np.concatenate(x) for x in zip(self.tokens, (a, a_end - word_start[a_word], b, b_end - word_start[b_word])))
        # a group is spelled as A's ids, a bar, and B's ids; the last of each has its own sign
        signs = [np.where(np.diff(g, append=-1) != 0, last, ord(",")) for g, last in ((a_group, ord("|")), (b_group, ord(";")))]
        order = np.argsort(np.concatenate((a_group * 2, b_group * 2 + 1)), kind="stable")
        self.spelled = np.concatenate((self.spelled, np.concatenate((a, b))[order]))
        self.signs = np.concatenate((self.signs, np.concatenate(signs)[order].astype(np.uint8)))
        return None

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of ``texts``, one text after the other, and the words of each text."""
        if len(self.index) > REMEMBERED:
            self.forget()
        number, known, seen, counts = self.index.__getitem__, len(self.index), [], []
        for text in texts:
            words = SINGLE_SPACE.split(text) if text else []
            seen.extend(map(number, words))
            counts.append(len(words))
        if len(self.index) > known:
            self.learn(list(self.index)[known:])
        return np.array(seen, np.int64), np.array(counts, np.int64)


@lru_cache(maxsize=1)
def aligner_of(tokenizer: str, model: bytes) -> Aligner:
    """One aligner per pair of tokenizers and Python worker."""
    return Aligner(tokenizer, model)


def read_tokenizers(tokenizer: str, model: str) -> tuple[str, bytes]:
    """The content of both files, which tasks get in their closure (a few megabytes)."""
    return Path(tokenizer).read_text(encoding="utf-8"), Path(model).read_bytes()


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values, kind))


SPANS = "a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>"
SLICED = (
    "slice long, id long, n_a long, n_b long, n_groups long, n_links long, groups string,"
    " pairs array<int>, times array<int>, dictionary array<long>, uses array<long>"
)


def align(df: DataFrame, tokenizer: str, model: bytes, id: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """One row per row of ``df``: slice, id, counts, ``groups`` and links; with ``spans`` also the ids and byte ends of all tokens.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids between two byte offsets where tokens of
    both end. ``pairs`` and ``times`` are the distinct linked pairs of the text, as places
    in its slice's ``dictionary``, and how many links each has. The first row of a slice
    holds the dictionary (A's id times 2^31 plus B's) and each pair's links in the slice.
    Ends count the space before the text. Texts that are null or empty, or that the
    tokens of A or B do not spell, have no tokens: zeros and empty lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, made = aligner_of(tokenizer, model), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", BYTES):
                yield _aligned(aligner, part, (task << 32) + made, spans)
                made += 1

    source = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"{SLICED}, {SPANS}" if spans else SLICED)


def _aligned(aligner: Aligner, part: pa.RecordBatch, slice_id: int, spans: bool) -> pa.RecordBatch:
    word, n_words = aligner.numbers(column(part, "text").to_pylist())
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    wrong = np.zeros(len(n_words), bool)
    wrong[text_of[aligner.bad[word]]] = True
    word, text_of = word[~wrong[text_of]], text_of[~wrong[text_of]]
    n_words = np.bincount(text_of, minlength=len(n_words))
    per_word = aligner.counts[word]
    totals = np.stack([np.bincount(text_of, per_word[:, k], len(n_words)).astype(np.int64) for k in range(4)], axis=1)
    groups = _spelled_groups(aligner, word, per_word[:, 0] + per_word[:, 1], totals[:, 0] + totals[:, 1])
    starts = np.cumsum(aligner.counts[:, 3]) - aligner.counts[:, 3]
    links = aligner.pairs[gather(starts[word], per_word[:, 3])]
    dictionary, place = np.unique(links, return_inverse=True)
    per_text, times = np.unique(np.repeat(text_of, per_word[:, 3]) * max(len(dictionary), 1) + place, return_counts=True)
    of, pairs = np.divmod(per_text, max(len(dictionary), 1))
    distinct = np.bincount(of, minlength=len(n_words))
    uses = np.bincount(place, minlength=len(dictionary)).astype(np.int64)
    only_first = np.where(np.arange(len(n_words)) == 0, len(dictionary), 0)
    columns = {
        "slice": pa.array(np.full(len(n_words), slice_id, np.int64)), "id": part.column(0),
        **{name: pa.array(totals[:, k]) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}, "groups": groups,
        "pairs": _lists(pairs, distinct, pa.int32()), "times": _lists(times, distinct, pa.int32()),
        "dictionary": _lists(dictionary, only_first, pa.int64()), "uses": _lists(uses, only_first, pa.int64()),
    }
    if spans:
        for side, n in enumerate(("a", "b")):
            firsts = np.cumsum(aligner.counts[:, side]) - aligner.counts[:, side]
            at = gather(firsts[word], per_word[:, side])
            sizes = np.array([0] * len(word), np.int64)
            last = firsts[word] + per_word[:, side] - 1
            sizes = aligner.tokens[2 * side + 1][last] if len(word) else sizes
            before = np.cumsum(sizes) - sizes
            first_word = np.concatenate(([0], np.cumsum(n_words)))[:-1]
            base = before[np.minimum(first_word, max(len(word) - 1, 0))] if len(word) else np.zeros(len(n_words), np.int64)
            shift = np.repeat(before - base[text_of], per_word[:, side])
            columns[f"{n}_ids"] = _lists(aligner.tokens[2 * side][at], totals[:, side], pa.int32())
            columns[f"{n}_ends"] = _lists(aligner.tokens[2 * side + 1][at] + shift, totals[:, side], pa.int32())
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _spelled_groups(aligner: Aligner, word: np.ndarray, per_word: np.ndarray, per_text: np.ndarray) -> pa.Array:
    """The groups of each text: the decimal ids of its words and their signs, without the last sign."""
    counts = aligner.counts[:, 0] + aligner.counts[:, 1]
    at = gather((np.cumsum(counts) - counts)[word], per_word)
    ids, digits = aligner.spelled[at], aligner.decimals
    lengths = digits.lengths[ids]
    ends = np.cumsum(lengths + 1)
    flat = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    flat[gather(ends - lengths - 1, lengths)] = digits.of(ids)
    flat[ends - 1] = aligner.signs[at]
    last = np.cumsum(per_text)[per_text > 0] - 1
    keep = np.ones(len(flat), bool)
    keep[ends[last] - 1] = False
    sizes = np.zeros(len(per_text), np.int64)
    sizes[per_text > 0] = np.diff(ends[last], prepend=0) - 1
    return strings(flat[keep], np.concatenate(([0], np.cumsum(sizes))))


def link_counts(aligned: DataFrame) -> DataFrame:
    """(a_id, b_id, n_links, best): corpus-wide links of each pair that is linked, and whether no pair of its B id has more."""
    return _rated(_entries(aligned)).select(
        F.expr(f"cast(pair div {PAIR} as int)").alias("a_id"), (F.col("pair") % PAIR).cast("int").alias("b_id"), F.col("count").alias("n_links"), "best"
    )


def _entries(aligned: DataFrame) -> DataFrame:
    """(slice, place, pair, n) of all dictionaries."""
    first = aligned.filter(F.size("dictionary") > 0)
    return first.select("slice", F.posexplode(F.arrays_zip("dictionary", "uses")).alias("place", "entry")).select(
        "slice", "place", F.col("entry.dictionary").alias("pair"), F.col("entry.uses").alias("n")
    )


def _rated(entries: DataFrame) -> DataFrame:
    counts = settled(entries.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    b = F.col("pair") % PAIR
    # one row per id of B's vocabulary at most
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), b == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def with_link_counts(aligned: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``aligned`` (stored, as it is read three times) with ``n_best`` and ``count_sum`` of each text.

    ``n_best`` counts the links whose pair has its B id's highest count in the corpus, ties
    included; ``count_sum`` adds the counts of all links. The work beyond the slices is on
    dictionaries: a pair stands in each once, and a slice is put together from no more
    entries than it has links.
    """
    entries = _entries(aligned)
    rated = entries.select("slice", "place", "pair").join(_rated(entries), "pair")
    told = rated.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("told"))
    told = told.select(F.col("slice").alias("of_slice"), F.col("told.count").alias("counts"), F.col("told.best").alias("bests"))
    schema = aligned.select(*columns).schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def work(texts: pd.DataFrame, dictionary: pd.DataFrame) -> pd.DataFrame:
        out = texts[columns].reset_index(drop=True)
        n_best, count_sum = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        if len(dictionary) and len(texts):
            counts, bests = np.asarray(dictionary["counts"].iat[0], np.int64), np.asarray(dictionary["bests"].iat[0], bool)
            for k, (pairs, times) in enumerate(zip(texts["pairs"], texts["times"])):
                n_best[k], count_sum[k] = times[bests[pairs]].sum(), (times * counts[pairs]).sum()
        out["n_best"], out["count_sum"] = n_best, count_sum
        return out

    needed = aligned.select(*dict.fromkeys(["slice", "pairs", "times", *columns]))
    return needed.groupBy("slice").cogroup(told.groupBy("of_slice")).applyInPandas(work, f"{schema}, n_best long, count_sum long")


def alignment(df: DataFrame, tokenizer: str, model: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id``, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups_sha256``.

    ``groups_sha256`` is the digest of ``align``'s ``groups``, empty for texts without
    tokens. Null ids stay null, rows alike are each counted, an empty table gives no
    rows; other columns are left out, so none can clash. A text is held whole, in a
    slice of its own if it is long.
    """
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    stored = settled(align(df, tokenizer, model, id, text).withColumn("groups_sha256", digest).drop("groups"), "aligned")
    told = with_link_counts(stored, ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return told.select(F.col("id").alias(id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
