"""The fill-in-middle transformation against plain slicing, and its inverse."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lakewright.llm.fill_in_middle import fill_in_middle, restore

MARKS = ("<P>", "<S>", "<M>")


def by_slicing(id: int | None, text: str | None) -> tuple:
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digits = hashlib.sha256(f"1:{id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if id is None or not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_equals_slicing_and_restores(spark):
    rng = random.Random(3)
    letters = ["a", "B", "xyz", " ", "\n", "<", ">", "P", "S", "M", "é", "日", "\U0001F600", "0", "\x00", "́", "<", "<S", "P>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(800)]
    texts += [None, "", "long word é" * 300_000, "<", "<P", "<P>", "P>", "a", "é", *texts[:20]]
    rows = [(k if k % 50 else None, t) for k, t in enumerate(texts)] + [(7, "again"), (7, "again"), (-3, "less than none"), (2**62, "far")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = restore(fill_in_middle(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_slicing(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "some words", "x", 5, None), (2, None, None, None, "y")], "doc_id long, text string, form string, n int, _drawn string")
    assert restore(fill_in_middle(df.filter("false"))).count() == 0
    rows = {r.doc_id: r for r in restore(fill_in_middle(df), text="text").collect()}
    assert rows[1].text == "some words" and rows[1].n == 3 and rows[2].text == "" and rows[2]["_drawn"] == "y"
    over = fill_in_middle(df, output="text").collect()
    assert {r.text for r in over} == {by_slicing(1, "some words")[4], ""}
    assert "text" not in fill_in_middle(df, keep_text=False).columns


@pytest.mark.parametrize("output, form, text", [
    ("<P>a<S>c<M>b", "psm", "abc"), ("<S>c<P>a<M>b", "spm", "abc"), ("<P><S><M>", "psm", ""), ("<P>a<S>c<M>b", "spm", None), ("no marks", "psm", None),
    ("x<P>a<S>c<M>b", "psm", None), ("<P>a<S>c<M>b<M>", "psm", None), ("<P>a", None, "<P>a"), (None, "plain", ""), ("<P><<S>S><M>P<", "psm", "<P<S>"),
])
def test_restore_of_single_outputs(spark, output, form, text):
    rows = spark.createDataFrame([(output, form), ("<P>1<S>3<M>2", "psm")], "output string, form string").coalesce(1)
    assert {r.restored for r in restore(rows).collect()} == {text, "123"}


def test_other_rates(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"))
    assert {r.form for r in fill_in_middle(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle(df, rate=100, suffix_first=100).collect()} == {"spm"}
