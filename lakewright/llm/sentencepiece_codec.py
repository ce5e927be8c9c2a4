"""SentencePiece BPE encoding and decoding over flat numpy arrays.

A text becomes ``▁`` (the dummy prefix) plus itself with ``▁`` for each space, and is
cut before every run of ``▁``: no piece has ``▁`` after another character, so merges
never cross those cuts. The distinct words of a batch are merged together in rounds.
Each round finds the lowest pair rank of every word, merges its leftmost pairs of that
rank in all words at once and compacts the arrays; words without a pair leave.

All pairs of a word's lowest rank are merged in one round only if no pair that contains
the merged piece ranks at or before it, else the leftmost alone, so the outcome is that
of merging one pair at a time.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
NO_RANK = np.iinfo(np.int32).max
#: Characters worked on at a time, and distinct words whose ids a task remembers.
CHARS, REMEMBERED = 1_000_000, 150_000

codecs.register_error("replace_each_byte", lambda error: ("�", error.start + 1))


def read_model(path: str) -> bytes:
    """The model file's bytes, which tasks get in their closure (half a megabyte)."""
    return Path(path).read_bytes()


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all runs ``starts[i]`` to ``starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class _Numbered(dict):
    """Gives each new key the next number."""

    def __missing__(self, key: object) -> int:
        self[key] = number = len(self)
        return number


def _words(text: str) -> list[str]:
    """The words of a text without the mark that each begins with."""
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in WORD.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


class Codec:
    """Tables of one model, and the words it has encoded last."""

    def __init__(self, model: bytes):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = vocabulary.get_piece_size()
        pieces = [vocabulary.id_to_piece(i) for i in range(size)]
        is_byte = np.array([vocabulary.is_byte(i) for i in range(size)])
        is_control = np.array([vocabulary.is_control(i) for i in range(size)])
        normal = [i for i in range(size) if not (is_byte[i] or is_control[i] or vocabulary.is_unknown(i))]
        if is_byte.sum() != 256 or any(vocabulary.is_unused(i) for i in normal):
            raise ValueError("only BPE models with byte fallback and without unused pieces are supported")
        self.size, self.end = size, vocabulary.eos_id()
        ids = {pieces[i]: i for i in normal}
        if any(c not in ids for p in ids for c in p) or any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece holds a character that is no piece, or a space mark after another character")
        self.byte_ids = np.array([vocabulary.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.char_ids = np.full(0x110000, -1, np.int64)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        self._pairs(ids, [vocabulary.get_score(i) for i in range(size)])
        self._surfaces(pieces, is_byte, is_control, vocabulary)
        self.forget()

    def _pairs(self, ids: dict[str, int], scores: list[float]) -> None:
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        rank = np.full(self.size, NO_RANK, np.int32)
        for i in ids.values():
            rank[i] = order[scores[i]]
        found = sorted(
            (ids[p[:k]] * self.size + ids[p[k:]], i)
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        )
        self.pair_keys = np.array([k for k, _ in found], np.int64)
        self.pair_ids = np.array([i for _, i in found], np.int64)
        self.pair_ranks = rank[self.pair_ids]
        # may all pairs that make a piece be merged at once? not if a pair with that piece ranks at or before it
        first = np.full(self.size, NO_RANK, np.int32)
        np.minimum.at(first, self.pair_keys // self.size, self.pair_ranks)
        np.minimum.at(first, self.pair_keys % self.size, self.pair_ranks)
        alone = np.bincount(rank[list(ids.values())], minlength=len(order))[np.where(rank < NO_RANK, rank, 0)] == 1
        self.at_once = (first > rank) & alone

    def _surfaces(self, pieces: list[str], is_byte: np.ndarray, is_control: np.ndarray, vocabulary) -> None:
        surfaces = []
        for i, p in enumerate(pieces):
            if is_byte[i]:
                surfaces.append(bytes([int(p[3:5], 16)]))
            elif is_control[i]:
                surfaces.append(b"")
            elif vocabulary.is_unknown(i):
                surfaces.append(vocabulary.decode([i]).encode())
            else:
                surfaces.append(p.replace(SPACE, " ").encode())
        self.surface_lengths = np.array([len(s) for s in surfaces], np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths
        self.surface_bytes = np.frombuffer(b"".join(surfaces), np.uint8)
        self.is_control = is_control
        self.space_first = np.array([not is_byte[i] and p.startswith(SPACE) for i, p in enumerate(pieces)])

    def forget(self) -> None:
        """Word 0 is the end of a text; its key is no string."""
        self.index = _Numbered({None: 0})
        self.word_ids = np.array([self.end], np.int64)
        self.word_lengths = np.array([1], np.int64)

    def _rank_pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks of pairs and the pieces they make."""
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        there = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(there, self.pair_ranks[at], NO_RANK), self.pair_ids[at]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words`` (each after a mark), one word after the other, and the number of ids of each."""
        codes = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        symbols = self.char_ids[codes]
        # a character that is no piece stays alone; it is kept as a negative number until the end
        symbols = np.where(symbols < 0, -2 - codes, symbols)
        ranks, made = np.full(len(symbols), NO_RANK, np.int32), np.zeros(len(symbols), np.int64)
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        fresh = np.flatnonzero(~last)
        open_words, done_words, done_symbols = np.arange(len(words)), [], []
        while len(open_words):
            ranks[fresh], made[fresh] = self._rank_pairs(symbols[fresh], symbols[fresh + 1])
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            idle = lowest == NO_RANK
            chosen = (ranks == np.repeat(lowest, lengths)) & (ranks < NO_RANK)
            at = np.flatnonzero(chosen)
            # of pairs that overlap in a chain take the first, third, ...; where order matters, the word's first
            chain = np.diff(at, prepend=-2) > 1
            in_chain = np.arange(len(at)) - np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
            word_of = np.searchsorted(starts, at, side="right") - 1
            first = np.diff(word_of, prepend=-1) > 0
            at = at[np.where(self.at_once[made[at]], in_chain % 2 == 0, first)]
            word_of = np.searchsorted(starts, at, side="right") - 1
            leaving = np.repeat(idle, lengths)
            done_words.append(np.repeat(open_words[idle], lengths[idle]))
            done_symbols.append(symbols[leaving])
            # the merged symbol stands in the left place; the right place goes and ends the word if it did
            symbols[at], last[at], ranks[at] = made[at], last[at + 1], NO_RANK
            stay = ~leaving
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            right_of = place[at[~last[at]]]
            at_start = np.zeros(len(symbols), bool)
            at_start[starts] = True
            left_of = place[at[~at_start[at]]] - 1
            touched = np.zeros(int(stay.sum()), bool)
            touched[left_of] = touched[right_of] = True
            fresh = np.flatnonzero(touched)
            lengths = (lengths - np.bincount(word_of, minlength=len(lengths)))[~idle]
            symbols, ranks, made, last = symbols[stay], ranks[stay], made[stay], last[stay]
            open_words = open_words[~idle]
        of, flat = np.concatenate(done_words or [open_words]), np.concatenate(done_symbols or [symbols])
        order = np.argsort(of, kind="stable")
        return self._bytes_for_unknown(of[order], flat[order], len(words))

    def _bytes_for_unknown(self, of: np.ndarray, flat: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        unknown = flat < 0
        if unknown.any():
            spelled = [chr(-2 - c).encode("utf-8", "replace") for c in flat[unknown]]
            repeats = np.ones(len(flat), np.int64)
            repeats[unknown] = [len(s) for s in spelled]
            of, flat, unknown = np.repeat(of, repeats), np.repeat(flat, repeats), np.repeat(unknown, repeats)
            flat[unknown] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return flat, np.bincount(of, minlength=n_words)

    def encode(self, texts: list[str | None], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (null: empty), one text after the other, and the number of ids of each."""
        if len(self.index) > REMEMBERED:
            self.forget()
        number, known, seen, counts = self.index.__getitem__, len(self.index), [], []
        for text in texts:
            words = _words(text) if text else []
            seen.extend(map(number, words))
            if end:
                seen.append(0)
            counts.append(len(words) + end)
        if len(self.index) > known:
            new_ids, new_lengths = self.merged(list(self.index)[known:])
            self.word_ids = np.concatenate((self.word_ids, new_ids))
            self.word_lengths = np.concatenate((self.word_lengths, new_lengths))
        at = np.array(seen, np.int64)
        lengths = self.word_lengths[at]
        starts = (np.cumsum(self.word_lengths) - self.word_lengths)[at]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        return self.word_ids[_gather(starts, lengths)], np.diff(ends[bounds])

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ``counts`` ids."""
        lengths = self.surface_lengths[flat]
        spelled = self.surface_bytes[_gather(self.surface_starts[flat], lengths)].tobytes()
        ends = np.concatenate(([0], np.cumsum(lengths)))
        bounds = np.concatenate(([0], np.cumsum(counts)))
        # the dummy prefix: one space of the first piece that is no control piece
        shown = np.flatnonzero(~self.is_control[flat])
        at = np.searchsorted(shown, bounds[:-1])
        texts = []
        for i, (start, stop) in enumerate(zip(ends[bounds[:-1]], ends[bounds[1:]])):
            prefixed = at[i] < len(shown) and shown[at[i]] < bounds[i + 1] and self.space_first[flat[shown[at[i]]]]
            texts.append(spelled[start + bool(prefixed) : stop].decode("utf-8", "replace_each_byte"))
        return texts


@lru_cache(maxsize=2)
def codec_of(model: bytes) -> Codec:
    """One codec per model and Python worker."""
    return Codec(model)


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``most``."""
    part = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(part)) + 1
    yield from zip([0, *edges], [*edges, len(sizes)])


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array, without: tuple[str, ...] = ()) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name and n not in without]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), values], [*(batch.schema.names[i] for i in kept), name])


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat.astype(np.int32)))


def _schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(
    df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", end: bool = True, keep_text: bool = True
) -> DataFrame:
    """``df`` with ``ids``, the library's ids of each whole ``text``, by default with an end id.

    Null and empty texts have no ids but the end id. Rows stay one for one; a column
    named like ``ids`` is replaced; ``text`` is left out on demand. A task holds a few megabytes of text at a time, so
    its memory is bounded by the longest single text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for whole in batches:
            texts = whole.column(whole.schema.get_field_index(text))
            for lo, hi in _slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) + 1, CHARS):
                flat, counts = codec.encode(texts.slice(lo, hi - lo).to_pylist(), end)
                yield _with_column(whole.slice(lo, hi - lo), ids, _lists(flat, counts), () if keep_text else (text,))

    kept = df if keep_text else df.drop(text)
    return df.mapInArrow(run, _schema_with(kept, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with ``text``, the library's decoding of each list ``ids``.

    One leading space, the dummy prefix, is taken off. Null lists decode to null, empty
    ones to an empty text. A column named like ``text`` is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for whole in batches:
            lists = whole.column(whole.schema.get_field_index(ids))
            sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in _slices(sizes + 1, CHARS):
                part = lists.slice(lo, hi - lo)
                texts = codec.decode(part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes[lo:hi])
                there = part.is_valid().to_pylist()
                column = pa.array([t if ok else None for t, ok in zip(texts, there)], pa.string())
                yield _with_column(whole.slice(lo, hi - lo), text, column)

    return df.mapInArrow(run, _schema_with(df, text, T.StringType()))


def round_trip(
    df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str = "decoded", end: bool = True, keep_text: bool = True
) -> DataFrame:
    """What ``decode`` gives for the rows of ``encode``, in one pass.

    The two after each other take two Python workers a core, each with the tables and words
    of the model, and both stay for the stages that follow; this takes one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for whole in batches:
            texts = whole.column(whole.schema.get_field_index(text))
            for lo, hi in _slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) + 1, CHARS):
                flat, counts = codec.encode(texts.slice(lo, hi - lo).to_pylist(), end)
                coded = _with_column(whole.slice(lo, hi - lo), ids, _lists(flat, counts), () if keep_text else (text,))
                yield _with_column(coded, decoded, pa.array(codec.decode(flat, counts), pa.string()))

    kept = df if keep_text else df.drop(text)
    schema = T.StructType([f for f in _schema_with(kept, ids, T.ArrayType(T.IntegerType())).fields if f.name != decoded])
    return df.mapInArrow(run, schema.add(decoded, T.StringType()))
