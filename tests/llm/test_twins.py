"""The registered queries against their SQL twins and brute force on the small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest

from lakewright.llm.queries import QUERIES, SQL
from tests.conftest import SMALL
from tests.oracle_compare import connect, differences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, SQL[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_quality_scores_every_document(spark, docs):
    rows = QUERIES["op1_quality_classifier"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_license_base_columns(spark, docs):
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    rows = {r.doc_id: r for r in QUERIES["op3_license_scan"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        words = WORD.findall((d.text or "").translate(LOWER))
        at = sorted((i, label) for label, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p)
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_token_counts(spark, docs):
    import public_tokenizers

    from lakewright.llm.token_counts import read_ranks

    vocabulary = set(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))

    def pieces(word: bytes) -> int:
        at = n = 0
        while at < len(word):
            at += next(k for k in range(len(word) - at, 0, -1) if word[at : at + k] in vocabulary)
            n += 1
        return n

    rows = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, SMALL).collect()}
    for d in docs:
        words = (d.text or "").split()
        r = rows[d.doc_id]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(pieces(b" " + w.encode()) for w in words), 0)


def test_sentencepiece_digests(spark, docs):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_eos=True)
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_native_queries_plan_no_python(spark):
    for name in ("op2_decontamination", "op5_feistel_shards", "op8_line_dedup", "op9_url_filter"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|MapPartitions|BroadcastNestedLoop|Cartesian", plan), name
