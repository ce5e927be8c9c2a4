"""Physical plans: one shuffle, broadcasts under the limit, pushdown, one scan per suite."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lakewright.catalog.base import table
from lakewright.catalog.joins import customer_history, shipped_items
from lakewright.operators.aggregates import histogram
from lakewright.operators.joins import enrich, pit_join
from lakewright.operators.quality import Check, run_suite
from lakewright.operators.skew import BROADCAST_LIMIT_BYTES, UNKNOWN_BYTES, planned_bytes, small
from lakewright.operators.windows import keep_latest, trend_metrics
from lakewright.streaming.features import user_features
from tests.conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan(df)))


def test_trend_uses_one_shuffle(spark):
    series = table(spark, SMALL, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_totalprice")
    for mode in ("rows", "calendar"):
        trends = trend_metrics(series, ["o_custkey"], "d", "o_totalprice", {"mom": 1, "yoy": 12}, mode=mode)
        assert shuffles(trends) == 1


def test_keep_latest_cuts_before_the_shuffle(spark):
    kept = keep_latest(table(spark, SMALL, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey"])
    text = plan(kept)
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text
    assert shuffles(kept) == 1


def test_features_combine_before_the_shuffle(spark):
    features = user_features(table(spark, SMALL, "events"), "ts")
    assert shuffles(features) == 1
    assert "partial_count" in plan(features)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan(features)


def test_filters_and_columns_reach_the_scan(spark):
    items = table(spark, SMALL, "lineitem").filter("l_quantity > 40").select("l_orderkey")
    assert "GreaterThan(l_quantity,40.0)" in plan(items)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan(items)


def test_small_dimension_is_broadcast(spark):
    joined = enrich(table(spark, SMALL, "customer"), table(spark, SMALL, "nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n"})
    assert "BroadcastHashJoin" in plan(joined) and shuffles(joined) == 0


def test_large_or_unbounded_frames_are_not_hinted(spark):
    items = table(spark, SMALL, "lineitem")
    assert "ResolvedHint" not in small(items, limit_bytes=10)._jdf.queryExecution().analyzed().toString()
    exploded = items.select(F.explode(F.sequence(F.lit(1), F.lit(10))))
    assert planned_bytes(exploded) == UNKNOWN_BYTES > BROADCAST_LIMIT_BYTES


def test_point_in_time_forms(spark):
    items, history = shipped_items(spark, SMALL), customer_history(spark, SMALL)
    take = {"o_orderpriority": "p"}
    assert "BroadcastHashJoin [o_custkey" in plan(pit_join(items, history, ["o_custkey"], "ship_day", take, method="broadcast"))
    with pytest.raises(ValueError):
        pit_join(items, history, ["o_custkey"], "ship_day", take, method="other")


def test_suite_scans_a_table_once(spark):
    checks = [
        Check("lineitem", "a", "min_value", "l_quantity", args={"min": 1}),
        Check("lineitem", "b", "not_null", "l_tax"),
        Check("lineitem", "c", "mean_between", "l_tax", args={"low": 0, "high": 1}),
        Check("lineitem", "d", "null_rate", "l_partkey", args={"max": 0.1}),
    ]
    text = plan(run_suite({"lineitem": table(spark, SMALL, "lineitem")}, checks))
    assert text.count("FileScan parquet") == 1


def test_histogram_reads_its_bounds_in_one_subquery(spark):
    df = histogram(table(spark, SMALL, "lineitem"), "l_quantity", 10)
    df.collect()
    assert df.count() <= 10


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    from lakewright.sinks.tables import overwrite_table

    orders = table(spark, SMALL, "orders").withColumn("y", F.year("o_orderdate")).repartition(8)
    overwrite_table(orders, str(tmp_path / "t"), ["y"])
    files = list((tmp_path / "t").glob("y=*/*.parquet"))
    assert len(files) == len(list((tmp_path / "t").glob("y=*")))
