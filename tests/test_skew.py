"""A third of the rows on one key, against brute force."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.operators.history import scd2_from_log, scd2_invariants
from lakewright.operators.joins import pit_join
from lakewright.operators.ranks import average_rank, exact_quantile
from lakewright.operators.sets import table_difference
from lakewright.operators.skew import crowded_keys, salted_join
from lakewright.operators.windows import keep_latest

N = 3000


@pytest.fixture(scope="module")
def lopsided(spark):
    """Key 0 has a third of the rows; a few rows have no key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 97 + 1).cast("int")
    day = F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") * 7 % 400).cast("int"))
    return spark.range(N).select("id", key.alias("k"), day.alias("d"), (F.col("id") * 31 % 50).cast("double").alias("v"))


def test_crowded_keys(lopsided):
    found = {r["k"]: r["_salts"] for r in crowded_keys(lopsided, ["k"], 0.05).collect()}
    assert found == {0: 7}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, lopsided, how):
    right = spark.range(50).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    salted = salted_join(lopsided, right, ["k"], how, share=0.05).select("l.id", "r.w")
    plain = lopsided.join(right, "k", how).select("id", "w")
    assert table_difference(plain, salted).count() == 0


def test_point_in_time_forms_agree(lopsided):
    log = lopsided.filter("k is not null").select("k", "d", "v", "id")
    dim = scd2_from_log(log, ["k"], ["v"], "d", ["id"])
    assert set(scd2_invariants(dim, ["k"]).first()) == {0}
    forms = [pit_join(lopsided, dim, ["k"], "d", {"v": "then"}, method=m).select("id", "then") for m in ("broadcast", "salted", "monthly", "plain", "sweep")]
    assert forms[0].count() == N
    for other in forms[1:]:
        assert table_difference(forms[0], other).count() == 0
    state, expected = {}, {}
    facts = sorted(lopsided.collect(), key=lambda r: (r["d"], r["id"]))
    for r in facts:
        state.setdefault(r["k"], {})[r["d"]] = r["v"]
    for r in facts:
        days = [d for d in state.get(r["k"], {}) if d <= r["d"]]
        expected[r["id"]] = state[r["k"]][max(days)] if r["k"] is not None and days else None
    assert {r["id"]: r["then"] for r in forms[0].collect()} == expected


def test_history_is_bounded_by_days(lopsided):
    log = lopsided.filter("k = 0").select("k", "d", "v", "id")
    dim = scd2_from_log(log, ["k"], ["v"], "d", ["id"])
    assert dim.count() <= log.select("d").distinct().count()
    assert dim.filter("is_current").count() == 1


def test_keep_latest_of_copies(lopsided):
    kept = {r["k"]: r["id"] for r in keep_latest(lopsided, ["k"], "d", ["id"]).collect()}
    best = {}
    for r in lopsided.collect():
        if r["k"] not in best or (r["d"], r["id"]) > best[r["k"]]:
            best[r["k"]] = (r["d"], r["id"])
    assert kept == {k: v[1] for k, v in best.items()}


@pytest.mark.parametrize("descending", [True, False])
def test_average_rank_by_brute_force(lopsided, descending):
    # the crowded value: a third of all rows share it
    rows = lopsided.withColumn("s", F.when(F.col("k") == 0, 7.5).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 211))
    got = {r["id"]: r["rank"] for r in average_rank(rows.select("id", "s"), "s", "rank", descending).collect()}
    values = {r["id"]: r["s"] for r in rows.collect()}
    present = np.array([v for v in values.values() if v is not None])
    for i, v in values.items():
        if v is None:
            assert got[i] is None
        else:
            ahead = (present > v).sum() if descending else (present < v).sum()
            assert got[i] == ahead + ((present == v).sum() + 1) / 2


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_quantile_by_brute_force(lopsided, share):
    values = [r["v"] for r in lopsided.collect()]
    assert exact_quantile(lopsided, "v", share).first()[0] == pytest.approx(np.quantile(values, share))


def test_table_difference(spark):
    a = spark.createDataFrame([(1, None)] * 5 + [(2, "x")], "i int, s string")
    b = spark.createDataFrame([(1, None)] * 3 + [(2, "x"), (3, "y")], "i int, s string")
    assert sorted(tuple(r) for r in table_difference(a, b).collect()) == [(1, None, 5, 3), (3, "y", 0, 1)]
    assert table_difference(a, a).count() == 0


def test_skewed_join_is_split_at_run_time(spark, lopsided):
    """AQE splits a crowded partition of an ordinary left join when it is large enough."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100b",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        right = spark.range(60).select(F.col("id").cast("int").alias("k"), "id")
        joined = lopsided.repartition(8).join(right, "k", "left")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


