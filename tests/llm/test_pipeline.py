"""The stages of the corpus pipeline on small tables, each against brute force."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakewright.llm import quality_classifier, sentencepiece_codec
from lakewright.llm.queries import QUERIES, piece_model
from lakewright.llm.tables import settled, table
from tests.conftest import SMALL
from tests.llm.test_cases import brute_components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage and what the last returned."""
    frames = [table(spark, SMALL, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(settled(stage(spark, frames[-1], SMALL), "test-stage"))
    return frames


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(steps):
    for frame in steps[1:-1]:
        assert frame.dtypes == steps[0].dtypes
    assert len(corpus_pipeline.STAGES) == 5


def test_quality_keeps_scores_from_the_threshold(spark, steps):
    model = quality_classifier.fit(steps[0], table(spark, SMALL, "labels"))
    scores = {r.doc_id: r.score for r in quality_classifier.score(steps[0], model).collect()}
    assert set(rows(steps[1])) == {i for i, s in scores.items() if s >= 0.7}


def test_lines(steps):
    before, after = rows(steps[1]), rows(steps[2])
    pages = {}
    for r in before.values():
        pages.setdefault(r.source, []).append({x.strip(" ") for x in r.text.split("\n")})
    for i, r in before.items():
        own = pages[r.source]

        def stays(line):
            n = sum(line.strip(" ") in p for p in own)
            return not line.strip(" ") or n < 3 or n <= 0.1 * len(own)

        text = "\n".join(x for x in r.text.split("\n") if stays(x))
        assert after[i].text == text and after[i].n_chars == len(text)


def test_lines_on_a_hundredth_of_a_source_go(spark):
    rows = [(k, "\n".join(["menu"] * (k < 5) + ["rare"] * (k < 3) + [f"own line {k}"]), "en", "s", 30) for k in range(500)]
    docs = spark.createDataFrame(rows, table(spark, SMALL, "documents").schema)
    texts = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, SMALL).collect()}
    assert texts == {k: "\n".join(["rare"] * (k < 3) + [f"own line {k}"]) for k in range(500)}


def test_near_copies(steps):
    before = {i: r.text for i, r in rows(steps[2]).items()}
    assert set(rows(steps[3])) == {i for i, c in brute_components(before, 80).items() if i == c}


def test_rows_with_one_id_or_none_are_judged_by_their_texts(spark):
    text, other, third = ("one two three four five six", "seven eight nine ten eleven twelve", "some more words that stand alone")
    given = [(1, text), (1, text), (1, other), (None, text), (None, third), (None, third), (0, other), (5, None), (5, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in given], table(spark, SMALL, "documents").schema).withColumn("_row", F.lit(3))
    kept = corpus_pipeline.near_copies(spark, docs, SMALL)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert sorted((r.doc_id is None, r.doc_id, r.text or "") for r in kept.collect() if r.doc_id is not None) == [
        (False, 0, other), (False, 1, text), (False, 5, ""), (False, 5, ""),
    ]
    assert sorted(r.text for r in kept.filter("doc_id IS NULL").collect()) == ["", third]


def test_a_contaminated_row_goes_alone(spark):
    item = table(spark, SMALL, "benchmark").filter("text IS NOT NULL").orderBy("item_id").first().text
    given = [(None, f"a {item} b"), (None, "clean words"), (3, item), (3, "clean, too"), (4, None)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in given], table(spark, SMALL, "documents").schema).withColumn("_bad", F.lit(1))
    assert sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.benchmarks(spark, docs, SMALL).collect()) == [(0, "clean words"), (3, "clean, too"), (4, "")]


def test_benchmarks(spark, steps):
    items = [WORD.findall(r.text.lower()) for r in table(spark, SMALL, "benchmark").collect()]
    gone = set(rows(steps[3])) - set(rows(steps[4]))
    for i, r in rows(steps[3]).items():
        words = WORD.findall(r.text.lower())
        hit = any(
            sum(x == y for x, y in zip(words[at : at + 13], item[k : k + 13])) >= 11
            for item in items for k in range(len(item) - 12) for at in range(len(words) - 12) if words[at] == item[k] or words[at + 1] == item[k + 1]
        )
        assert hit == (i in gone)


def test_pieces(steps):
    last = rows(steps[5])
    assert set(last) == set(rows(steps[4])) and all(r.same_text and r.n_tokens == len(r.ids) for r in last.values())


def test_run_gives_the_rows_of_the_stages(spark, steps):
    assert sorted(corpus_pipeline.run(spark, SMALL).select("doc_id", "n_tokens").collect()) == sorted(steps[5].select("doc_id", "n_tokens").collect())


def test_empty_documents(spark):
    docs = table(spark, SMALL, "documents").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SMALL), "test-empty")
    assert docs.count() == 0


def test_nothing_is_rejected_without_both_labels(spark):
    docs = table(spark, SMALL, "documents")
    known = table(spark, SMALL, "labels").filter("quality = 1").join(docs.select("doc_id"), "doc_id")
    good = docs.join(known.select("doc_id"), "doc_id", "left_semi").select(*corpus_pipeline.COLUMNS)
    assert corpus_pipeline.quality(spark, good, SMALL).count() == good.count() > 0


def test_odd_rows(spark):
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words here", "en", None, 15)],
        table(spark, SMALL, "documents").schema,
    )
    for _, stage in corpus_pipeline.STAGES:
        odd = settled(stage(spark, odd, SMALL), "test-odd")
    assert odd.count() == 4 and all(r.same_text for r in odd.collect())


def test_pieces_are_coded_and_decoded_by_one_worker(spark, steps):
    """Two chained passes would take two Python workers a core, each with the model's tables and words."""
    stage = corpus_pipeline.STAGES[-1][1]
    for frame in (stage(spark, steps[-2], SMALL), QUERIES["op7_sentencepiece"](spark, SMALL)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_round_trip_equals_encode_and_decode(spark):
    texts = ["", None, " a  b ", "▁x", "tab\t€🙂", "plain words"]
    frame = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    model = piece_model()
    for keep in (True, False):
        apart = sentencepiece_codec.decode(sentencepiece_codec.encode(frame, model, keep_text=keep), model)
        once = sentencepiece_codec.round_trip(frame, model, keep_text=keep)
        assert once.dtypes == apart.dtypes and sorted(once.collect()) == sorted(apart.collect())
    assert sentencepiece_codec.round_trip(frame.limit(0), model).count() == 0
