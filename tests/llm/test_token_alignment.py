"""The alignment of two tokenizers against whole texts coded by the libraries and a plain double loop."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakewright.llm import token_alignment
from lakewright.llm.queries import QUERIES
from tests.conftest import SMALL

FILES = token_alignment.read_tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def brute():
    """(ids and byte ends under A, the same under B) of a whole text, from decoded bytes alone."""
    a = Tokenizer.from_str(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=FILES[1])
    names, of = {i: s for s, i in a.get_vocab().items()}, token_alignment.byte_of_symbol()

    def coded(text):
        if not text:
            return [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(of[c] for c in names[i]) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return [], []
        sides = []
        for ids, spelled in ((ids_a, bytes_a), (ids_b, bytes_b)):
            end, told = 0, []
            for i, x in zip(ids, spelled):
                end += len(x)
                told.append((i, end - len(x), end))
            sides.append(told)
        return tuple(sides)

    return coded


def whole(texts, coded):
    """What the query returns for each of ``texts``."""
    sides = [coded(t) for t in texts]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in sides]
    counts = Counter(p for told in links for p in told)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    for (a, b), told in zip(sides, links):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ";".join(
            ",".join(str(i) for i, _, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in b if lo < e <= hi) for lo, hi in zip([0, *cuts], cuts)
        )
        yield (
            len(a), len(b), len(cuts), len(told), sum(counts[p] == most[p[1]] for p in told), sum(counts[p] for p in told),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )


def odd_texts():
    rng = random.Random(5)
    letters = [" ", " ", "a", "the", "é", "日本", "\U0001F600", "\n", "\t", "  ", "▁", "<|endoftext|>", "'s", "12", "=-", "é", " ", "\x00", "\x1f", "ſ", "﷽", "don't", "​"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(400)]
    return [*texts, None, "", " ", "  ", "\n", "a", " a", "a ", "a " * 3000, "日" * 500, "\U0001F468‍\U0001F469‍\U0001F467 x", *texts[:9]]


def test_equals_a_double_loop(spark, brute):
    texts = odd_texts()
    df = spark.createDataFrame([(k, t, "x", k) for k, t in enumerate(texts)], "doc_id long, text string, slice string, n_a int").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.alignment(df, *FILES).collect()}
    assert [got[k] for k in range(len(texts))] == list(whole(texts, brute))
    assert token_alignment.alignment(df.filter("false"), *FILES).count() == 0


def test_small_slices_and_a_short_memory_give_the_same(spark, brute, monkeypatch):
    monkeypatch.setattr(token_alignment, "BYTES", 200)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 5)
    texts = odd_texts()[:60]
    part = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    batches = list(part.toArrow().to_batches())
    aligner = token_alignment.Aligner(*FILES)
    rows = [r for batch in batches for piece in token_alignment.slices(batch, "text", 200) for r in token_alignment._aligned(aligner, piece, 0, True).to_pylist()]
    for r, text in zip(rows, texts):
        a, b = brute(text)
        assert (r["a_ids"], r["a_ends"]) == ([x[0] for x in a], [x[2] for x in a])
        assert (r["b_ids"], r["b_ends"]) == ([x[0] for x in b], [x[2] for x in b])


def test_white_space_at_the_edges_of_texts_coded_together(brute):
    import pyarrow as pa

    texts = ["the cat ", "a dog", "b  ", " c", "d\n", "  e", "f\t", "\n", "g \n", "\n h", "  ", "i\u00a0", "j\x1c", " k l "]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    rows = token_alignment._aligned(token_alignment.Aligner(*FILES), batch, 0, True).to_pylist()
    for r, text in zip(rows, texts):
        a, b = brute(text)
        assert (r["a_ids"], r["a_ends"]) == ([x[0] for x in a], [x[2] for x in a]), text
        assert (r["b_ids"], r["b_ends"]) == ([x[0] for x in b], [x[2] for x in b]), text


def test_links_of_the_corpus(spark, brute):
    texts = ["the cat and the dog", "the cat", "日本 the"]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    counts = Counter((x[0], y[0]) for t in texts for x in brute(t)[0] for y in brute(t)[1] if x[1] < y[2] and y[1] < x[2])
    got = {(r.a_id, r.b_id): r.n_links for r in token_alignment.link_counts(token_alignment.align(df, *FILES)).collect()}
    assert got == counts
    assert [r.doc_id for r in token_alignment.alignment(df, *FILES).collect()] == [None] * 3


def test_the_query_on_all_small_documents(spark, brute):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_alignment"](spark, SMALL).collect()}
    docs = [d for d in docs if len(d.text or "") < 4000]
    sides = {d.doc_id: brute(d.text) for d in docs}
    for d in docs:
        a, b = sides[d.doc_id]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        assert got[d.doc_id][:3] == (len(a), len(b), len(cuts))


def test_ends_between_told_cuts():
    import numpy as np

    lengths, first = np.array([2, 1, 1, 3, 2, 2]), np.array([0, 4])
    assert token_alignment.refined(lengths, np.array([2, -1, 4, 7, -1, 4]), first).tolist() == [2, 3, 4, 7, 2, 4]
    assert token_alignment.refined(lengths, np.array([2, -1, 9, 7, -1, 4]), first).tolist() == [2, 3, 4, 7, 2, 4]


def test_ids_of_b_are_read_without_spans():
    """Spans of B cost more than its coding and tell nothing that the bytes of its ids do not."""
    aligner = token_alignment.Aligner(*FILES)
    library, asked = aligner.b, []

    class Recorder:
        def encode(self, texts, **options):
            asked.append(options.get("return_type"))
            return library.encode(texts, **options)

    aligner.b = Recorder()
    text = "naïve  words\n€ 🙂 done"
    ids, counts, ends = aligner._b([text, "x"])
    assert counts.sum() == len(ids) and ends[counts[0] - 1] == len(text.encode()) + 1 and ends[-1] == 2
    assert asked and "proto" not in asked
