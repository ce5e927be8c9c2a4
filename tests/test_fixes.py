"""Cases in which earlier forms cut values, lost rows or overwrote history."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakewright.functions.keys import hash_key
from lakewright.functions.numbers import rounded
from lakewright.operators.aggregates import dirty_number_stats, histogram
from lakewright.operators.history import prepare_versions, scd2_apply, snapshot, snapshot_start
from lakewright.operators.quality import Check, failing_rows, run_suite
from lakewright.operators.ranks import average_rank, exact_quantile
from lakewright.operators.windows import trend_metrics
from lakewright.session import scratch_path
from lakewright.sinks.tables import SchemaMismatch, append_table, overwrite_table
from lakewright.sources.files import read_table
from lakewright.sources.seeds import yearly_holidays
from lakewright.sources.streams import table_stream
from lakewright.streaming.events import first_of_each
from lakewright.streaming.features import EventNames, user_features
from lakewright.streaming.ingest import RowsRefused, run_available, start_append

NAMES = EventNames("click", "purchase", "signup", "view")


@pytest.mark.parametrize("files", [1, 24, 200])
def test_a_replay_of_unordered_files_loses_nothing(spark, files):
    events = spark.range(2000).select(
        F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"), F.lit("click").alias("event_type"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(864_000))).alias("ts"),
    )
    log = scratch_path(spark, "unordered")
    events.repartition(files).write.parquet(log)

    def stored(stream):
        out = scratch_path(spark, "replayed")
        run_available(start_append(stream, out, scratch_path(spark, "replay-state"), every=None), all_rows=True)
        return read_table(spark, out)

    whole = table_stream(spark, log, events.schema, max_files=None)
    assert stored(first_of_each(whole, ["event_id"], "ts")).count() == 2000
    closed = F.col("window_end") <= events.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).scalar()
    expected = user_features(events, "ts", names=NAMES).filter(closed)
    got = stored(user_features(whole, "ts", watermark="10 minutes", names=NAMES))
    assert sorted(got.collect()) == sorted(expected.collect())
    if files == 24:
        with pytest.raises(RowsRefused):
            stored(first_of_each(table_stream(spark, log, events.schema, max_files=1), ["event_id"], "ts"))


def test_small_and_large_values_are_not_cut(spark):
    df = spark.createDataFrame([("a", date(2024, m, 1), v) for m, v in ((1, 1e-6), (2, 3e-6), (3, 1e20))], "k string, month date, v double")
    rows = trend_metrics(df, ["k"], "month", "v", {"mom": 1}, rolling=2, change_digits=None, percent_digits=None, rolling_digits=None)
    assert [r.rolling_2_avg for r in rows.orderBy("month").collect()] == pytest.approx([1e-6, 2e-6, 5e19])
    assert trend_metrics(df, ["k"], "month", "v", {"mom": 1}).count() == 3
    text = df.select(F.col("v").cast("string").alias("v"))
    assert dirty_number_stats(text, "v").first().mean_value == pytest.approx(1e20 / 3)
    assert spark.range(1).select(rounded(F.lit(1e30), 2).alias("x")).first().x == 1e30
    checks = [Check("t", "mean", "mean_between", "v", args={"low": 1e-6, "high": 1e21})]
    assert run_suite({"t": df}, checks).first().status == "PASS"


def test_a_late_batch_is_refused(spark):
    def batch(status, day):
        return prepare_versions(spark.createDataFrame([(1, status)], "k int, status string"), ["k"], day)

    dim = batch("a", date(2026, 1, 1))
    dim = scd2_apply(dim, batch("b", date(2026, 6, 1)), ["k"], ["status"], date(2026, 6, 1))
    with pytest.raises(Exception, match="late batch"):
        scd2_apply(dim, batch("c", date(2026, 3, 1)), ["k"], ["status"], date(2026, 3, 1)).collect()
    assert scd2_apply(dim, batch("b", date(2026, 3, 1)), ["k"], ["status"], date(2026, 3, 1)).count() == 2
    same_day = scd2_apply(dim, batch("c", date(2026, 6, 1)), ["k"], ["status"], date(2026, 6, 1)).filter("is_current").collect()
    assert [(r.status, r.effective_date) for r in same_day] == [("c", date(2026, 6, 1))]


def test_a_null_key_keeps_one_open_snapshot(spark):
    def look(at):
        return spark.createDataFrame([(None, "x", datetime(2026, 1, at))], "k int, v string, at timestamp")

    first = snapshot_start(look(1), "k", "at")
    second = snapshot(first, look(2), "k", "at", datetime(2026, 1, 3))
    assert sorted((r.valid_from.day, r.valid_to and r.valid_to.day) for r in second.collect()) == [(1, 2), (2, None)]


def test_quality_counts(spark):
    big, small = spark.range(10), spark.range(3)
    check = Check("big", "enough", "at_least_count", args={"other": "small"})
    assert run_suite({"big": big, "small": small}, [check]).first().failing_rows == 0
    short = Check("small", "enough", "at_least_count", args={"other": "big"})
    assert run_suite({"big": big, "small": small}, [short]).first().failing_rows == 7
    twice = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert failing_rows(twice, Check("t", "pk", "no_duplicates", columns=("k",))).count() == 1
    assert failing_rows(twice, Check("t", "u", "unique", columns=("k",))).count() == 0


def test_histogram_of_one_value_and_of_odd_numbers(spark):
    one = spark.range(5).select(F.lit(2.0).alias("v"))
    assert [(r.bin, r.n_rows, r.bin_start, r.bin_end) for r in histogram(one, "v").collect()] == [(0, 5, 2.0, 2.0)]
    odd = spark.createDataFrame([(float(k),) for k in range(11)] + [(float("nan"),), (float("inf"),), (None,)], "v double")
    rows = histogram(odd, "v", 5).collect()
    assert sum(r.n_rows for r in rows) == 11 and {r.bin for r in rows} == set(range(5))


def test_ranks_with_infinities_and_one_value(spark):
    odd = spark.createDataFrame([(float(k),) for k in range(1000)] + [(float("inf"),), (float("-inf"),)], "v double")
    ranks = {r.v: r.avg_rank for r in average_rank(odd, "v", descending=False).collect()}
    assert ranks[float("-inf")] == 1.0 and ranks[0.0] == 2.0 and ranks[float("inf")] == 1002.0
    same = spark.range(4000).select(F.lit(7.0).alias("v"))
    assert exact_quantile(same, "v", 0.5).first().quantile == 7.0
    assert {r.avg_rank for r in average_rank(same, "v").collect()} == {2000.5}


def test_keys_of_different_parts_differ(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), ("_null_", "x"), (None, "x"), ("a\\", "b"), ("a", "\\b"), ("a\\|b", "c")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.select(hash_key(["a", "b"]).alias("k")).distinct().count() == len(pairs)
    plain = df.select(hash_key(["a", "b"], plain=True).alias("k")).distinct().count()
    assert plain < len(pairs)


def test_leap_days(spark):
    days = yearly_holidays(spark, date(2023, 1, 1), date(2025, 12, 31), [(2, 29)])
    assert [r.holiday_date for r in days.collect()] == [date(2024, 2, 29)]


def test_other_types_are_refused(spark):
    path = scratch_path(spark, "typed")
    overwrite_table(spark.range(3), path)
    text = spark.range(3).select(F.col("id").cast("string").alias("id"))
    for write in (overwrite_table, append_table):
        with pytest.raises(SchemaMismatch):
            write(text, path)
    assert read_table(spark, path).count() == 3
