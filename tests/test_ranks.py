"""Ranks and quantiles over data-sized ranges."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.operators.ranks import exact_quantile, value_positions, value_ranges
from lakewright.session import stored


@pytest.fixture(scope="module")
def narrow(spark):
    """A million distinct values, all but a few hundred of them in a millionth of the span."""
    value = F.when(F.col("id") % 4000 == 0, F.col("id") * 1.0).otherwise(5.0 + F.col("id") * 1e-9)
    return stored(spark.range(1_000_000).select(value.alias("v")), "narrow")


def test_no_range_is_much_longer_than_asked_for(narrow):
    counts = stored(narrow.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "narrow-counts")
    ranged = value_ranges(counts, F.col("v").asc(), 20_000)
    sizes = ranged.groupBy("_range", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    sizes = sorted(sizes, key=lambda r: (r["_range"], r["_part"]))
    assert sum(r.n for r in sizes) == 1_000_000 and max(r.n for r in sizes) <= 60_000 and len(sizes) >= 40
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:]))


def test_long_ranges_are_dealt_again(spark, narrow, monkeypatch):
    """A sample of one row per range bounds them badly, so a second level has to."""
    counts = stored(narrow.limit(200_000).groupBy("v").agg(F.count(F.lit(1)).alias("n")), "narrow-counts")
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "1")
        ranged = value_ranges(counts, F.col("v").asc(), 5_000)
        spark.conf.set(name, before)
        rows = ranged.groupBy("_range", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    finally:
        spark.conf.set(name, before)
    rows = sorted(rows, key=lambda r: (r["_range"], r["_part"]))
    assert sum(r.n for r in rows) == counts.count() and any(r["_part"] > 0 for r in rows)
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("range_values", [7, 40, 10_000])
def test_positions_and_quantiles(spark, range_values):
    rng = np.random.default_rng(3)
    values = [float(x) for x in rng.integers(0, 60, 300)] + [float("inf")] * 4 + [float("-inf")] * 3 + [float("nan")] * 5 + [None] * 6 + [-0.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    present = sorted((x for x in values if x is not None), key=lambda x: (x != x, x))
    ahead = {}
    for k, x in enumerate(present):
        ahead.setdefault("nan" if x != x else x, k)
    got = {"nan" if r.v != r.v else r.v: r.ahead for r in value_positions(df, "v", range_values=range_values).collect()}
    assert got == ahead
    finite = df.filter("abs(v) < 1000")
    told = [x for x in present if abs(x) < 1000]
    for share in (0.0, 0.1, 0.5, 0.977, 1.0):
        assert exact_quantile(finite, "v", share, range_values=range_values).first()[0] == pytest.approx(np.quantile(told, share))
    assert exact_quantile(df.filter("v > 59 OR v < 0"), "v", 0.0).first()[0] == float("-inf")
    assert exact_quantile(df.filter("v IS NULL"), "v", 0.5).first()[0] is None


def test_texts_are_ranked_without_a_function_of_its_own(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "v string")
    positions = value_positions(df, "v", descending=True, range_values=1)
    assert {r.v: r.ahead for r in positions.collect()} == {"c": 0, "b": 1, "a": 3}
    assert "UDF" not in positions._jdf.queryExecution().executedPlan().toString()
