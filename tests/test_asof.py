"""The point-in-time sweep against brute force, and how evenly it deals a crowded key."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakewright.operators.asof import sweep_join, swept_rows
from lakewright.operators.joins import pit_join
from lakewright.operators.sets import table_difference
from lakewright.session import stored

VERSIONS = "k int, effective_date date, end_date date, is_current boolean, state int"


def random_history(rng, keys):
    """Versions with gaps and ends, some keys without an open one, some with none at all."""
    rows = []
    for k in keys:
        day = date(2020, 1, 1) + timedelta(days=rng.randrange(200))
        for n in range(rng.randrange(6)):
            end = day + timedelta(days=rng.randrange(0, 90))
            rows.append([k, day, end, False, 100 * k + n])
            day = end + timedelta(days=rng.choice([1, 1, 1, 20]))
        if rows and rows[-1][0] == k and rng.random() < 0.6:
            rows[-1][2:4] = [None, True]
    return rows + [[None, date(2020, 1, 1), None, True, -1], [3, None, None, False, -2]]


@pytest.mark.parametrize("end_inclusive", [True, False])
@pytest.mark.parametrize("grain", ["month", "day", "year"])
def test_equals_brute_force(spark, grain, end_inclusive):
    rng = random.Random(11)
    versions = random_history(rng, range(12))
    facts = [
        (i, None if i % 37 == 0 else 5 if i % 3 == 0 else rng.randrange(14), None if i % 41 == 0 else date(2019, 12, 1) + timedelta(days=rng.randrange(900)), "same")
        for i in range(900)
    ]
    dim = spark.createDataFrame([tuple(v) for v in versions], VERSIONS)
    fact = spark.createDataFrame(facts, "id int, k int, d date, _fact string").repartition(5)
    got = {
        r.id: r.then
        for r in sweep_join(fact, dim, ["k"], "d", {"state": "then"}, end_inclusive=end_inclusive, grain=grain, share=0.01).collect()
    }
    assert len(got) == len(facts)
    for i, k, d, _ in facts:
        valid = [
            v[4] for v in versions
            if k is not None and d is not None and v[0] == k and v[1] is not None and v[1] <= d and (v[3] or (d <= v[2] if end_inclusive else d < v[2]))
        ]
        assert got[i] == (valid[0] if valid else None), (i, k, d)


def test_instants_and_other_names(spark):
    t = datetime(2024, 5, 31, 23, 59)
    dim = spark.createDataFrame([("a", t, t + timedelta(minutes=2), False, 1), ("a", t + timedelta(minutes=2), None, True, 2)], "key string, f timestamp, u timestamp, cur boolean, s int")
    fact = spark.createDataFrame([("a", t + timedelta(minutes=m), m) for m in (-1, 0, 1, 2, 3, 99999)], "key string, at timestamp, id int")
    got = {r.id: r.then for r in sweep_join(fact, dim, ["key"], "at", {"s": "then"}, "f", "u", "cur", end_inclusive=False).collect()}
    assert got == {-1: None, 0: 1, 1: 1, 2: 2, 3: 2, 99999: 2}
    assert sweep_join(fact.filter("false"), dim, ["key"], "at", {"s": "then"}, "f", "u", "cur").count() == 0
    assert {r.then for r in sweep_join(fact, dim.filter("false"), ["key"], "at", {"s": "then"}, "f", "u", "cur").collect()} == {None}


def test_a_crowded_key_with_many_versions_is_dealt_evenly(spark):
    """10,000 versions and half of 200,000 facts on one key, a tenth of them in one month."""
    start = F.date_add(F.lit(date(1995, 1, 1)), F.col("id").cast("int"))
    dim = spark.range(10_000).select(
        F.lit(0).alias("k"), start.alias("effective_date"), F.when(F.col("id") < 9_999, start).alias("end_date"), (F.col("id") == 9_999).alias("is_current"),
        F.col("id").alias("state"),
    )
    day = F.when(F.col("id") % 10 == 0, F.col("id") % 28).otherwise(F.col("id") * 7919 % 10_000).cast("int")
    fact = spark.range(200_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500).cast("int").alias("k"), F.date_add(F.lit(date(1995, 1, 1)), day).alias("d"))
    rows = swept_rows(fact, dim, ["k"], "d", "effective_date", "month", 0.001)
    groups = rows.groupBy("k", "_cell", "_salt").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_kind") == 0).alias("v"))
    largest = groups.agg(F.max("n").alias("n"), F.max("v").alias("v"), F.sum("n").alias("all")).first()
    assert largest["n"] < 2 * 200 + 40 and largest["v"] <= 32
    # versions are repeated in the crowded cells only
    assert largest["all"] < 200_000 + 2 * 10_000 + 100 * 32 + 2 * 330  # a crowded month, two salts in the others, one edge each
    swept = pit_join(fact, dim, ["k"], "d", {"state": "then"}, method="sweep")
    assert table_difference(swept, pit_join(fact, dim, ["k"], "d", {"state": "then"}, method="monthly")).count() == 0


def test_auto_sweeps_beyond_the_limit(spark, monkeypatch):
    # stored, as the size of a local frame made by Python is not known
    dim = stored(spark.createDataFrame([(1, date(2024, 1, 1), None, True, 7)], VERSIONS), "dim")
    fact = spark.createDataFrame([(1, 1, date(2024, 2, 2))], "id int, k int, d date")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Window" not in plan(pit_join(fact, dim, ["k"], "d", {"state": "then"}))
    monkeypatch.setattr("lakewright.operators.joins.BROADCAST_LIMIT_BYTES", 1)
    joined = pit_join(fact, dim, ["k"], "d", {"state": "then"})
    assert "Window" in plan(joined) and joined.collect()[0]["then"] == 7
    with pytest.raises(ValueError):
        sweep_join(fact, dim, ["k"], "d", {"state": "then"}, grain="minute")


@pytest.mark.parametrize("end_inclusive", [True, False])
@pytest.mark.parametrize("method", ["chunked", "monthly"])
def test_lists_of_versions_equal_brute_force(spark, method, end_inclusive):
    rng = random.Random(13)
    versions = random_history(rng, range(12))
    busy = [[50, date(2020, 1, 1) + timedelta(days=3 * n), date(2020, 1, 2) + timedelta(days=3 * n), False, n] for n in range(200)]
    versions = [*versions, *busy, [51, date(2020, 1, 5), None, True, 5100]]
    facts = [
        (i, None if i % 37 == 0 else rng.choice([50, 51, rng.randrange(14)]), None if i % 41 == 0 else date(2019, 12, 1) + timedelta(days=rng.randrange(900)))
        for i in range(900)
    ] + [(900, 51, date(9999, 12, 31)), (901, 50, date(9999, 12, 31))]
    dim = spark.createDataFrame([tuple(v) for v in versions], VERSIONS)
    fact = spark.createDataFrame(facts, "id int, k int, d date").repartition(5)
    joined = pit_join(fact, dim, ["k"], "d", {"state": "then", "effective_date": "since"}, end_inclusive=end_inclusive, method=method).collect()
    got = {r.id: (r.then, r.since) for r in joined}
    assert len(joined) == len(got) == len(facts)
    for i, k, d in facts:
        valid = [
            (v[4], v[1]) for v in versions
            if k is not None and d is not None and v[0] == k and v[1] is not None and v[1] <= d and (v[3] or (d <= v[2] if end_inclusive else d < v[2]))
        ]
        assert got[i] == (valid[0] if valid else (None, None)), (i, k, d)
    assert pit_join(fact.filter("false"), dim, ["k"], "d", {"state": "then"}, method=method).count() == 0
    assert {r.then for r in pit_join(fact, dim.filter("false"), ["k"], "d", {"state": "then"}, method=method).collect()} == {None}


@pytest.mark.parametrize("method", ["auto", "monthly"])
def test_facts_are_read_once(spark, monkeypatch, method):
    monkeypatch.setattr("lakewright.operators.joins.BROADCAST_LIMIT_BYTES", 1)
    dim = stored(spark.createDataFrame([(1, date(2024, 1, 1), None, True, 7)], VERSIONS), "dim")
    facts = stored(spark.createDataFrame([(1, 1, date(2024, 2, 2))], "id int, k int, d date"), "facts-read-once")
    joined = pit_join(facts, dim, ["k"], "d", {"state": "then"}, method=method)
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Relation [id#") == 1
    unreadable = facts.withColumn("d", F.expr("if(id = 1, raise_error('read'), d)"))
    pit_join(unreadable, dim, ["k"], "d", {"state": "then"}, method=method)


def test_lists_have_about_the_root_of_all_versions(spark):
    dim = spark.range(400).select(
        F.lit(1).alias("k"), F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("effective_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"), "id",
    )
    fact = spark.createDataFrame([(1, date(2020, 1, 1) + timedelta(days=d)) for d in (-1, 0, 19, 20, 399, 5000)], "k int, d date")
    got = {r.d: r.v for r in pit_join(fact, dim, ["k"], "d", {"id": "v"}, method="chunked").collect()}
    assert [got[date(2020, 1, 1) + timedelta(days=d)] for d in (-1, 0, 19, 20, 399, 5000)] == [None, 0, 19, 20, 399, 399]


def test_only_busy_keys_are_cut_into_cells(spark):
    """Each fact and version start of other keys moves once, in its key's one group."""
    dim = spark.range(300).select(
        (F.col("id") % 100).cast("int").alias("k"), F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"), "id",
    )
    fact = spark.range(6000).select("id", (F.col("id") % 100).cast("int").alias("k"), F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("d"))
    rows = swept_rows(fact, dim, ["k"], "d", "effective_date", "month", 0.05)
    assert rows.count() == 6300 and rows.filter("_cell IS NOT NULL OR _salt > 0").count() == 0
