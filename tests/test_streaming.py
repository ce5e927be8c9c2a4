"""Streams against batches, restarts and repeated deliveries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lakewright.operators.sets import table_difference
from lakewright.plans.engagement import refresh_features
from lakewright.sinks.tables import append_table
from lakewright.sources.files import read_table
from lakewright.sources.streams import table_stream
from lakewright.streaming.events import first_of_each, start_upsert
from lakewright.streaming.features import content_features, user_features
from lakewright.streaming.ingest import run_available, start_append

T0 = datetime(2026, 1, 1, 12, 0)
KINDS = ["like", "share", "comment", "impression"]


def events(spark, n, start=0):
    """One user has a third of the events."""
    at = F.lit(T0) + F.make_dt_interval(secs=(F.col("id") * 7).cast("decimal(18,6)"))
    user = F.when(F.col("id") % 3 == 0, "star").otherwise(F.concat(F.lit("u"), (F.col("id") % 20).cast("string")))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return spark.range(start, n, 1, 1).select(
        F.col("id").cast("string").alias("event_id"),
        user.alias("user_id"),
        F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("content_id"),
        F.element_at(kinds, (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        at.cast("timestamp").alias("event_ts"),
    )


def test_closed_windows_equal_the_batch(spark, tmp_path):
    log, out, state = (str(tmp_path / n) for n in ("log", "out", "state"))
    rows = events(spark, 600)
    append_table(rows, log)
    stream = user_features(table_stream(spark, log, rows.schema), watermark="10 minutes")
    run_available(start_append(stream, out, state, every=None))
    newest = rows.agg(F.max("event_ts")).first()[0]
    closed = user_features(rows).filter(F.col("window_end") <= F.lit(newest - timedelta(minutes=10)))
    assert closed.count() > 0
    assert table_difference(closed, read_table(spark, out)).count() == 0


def test_late_copy_and_late_row_are_dropped(spark, tmp_path):
    log, out, state = (str(tmp_path / n) for n in ("log", "out", "state"))
    rows = spark.createDataFrame([("a", T0), ("a", T0), ("b", T0 + timedelta(hours=2))], "event_id string, event_ts timestamp")
    late = spark.createDataFrame([("c", T0), ("d", T0 + timedelta(hours=2))], rows.schema)
    for part in (rows, late):
        append_table(part.coalesce(1), log)
        run_available(start_append(first_of_each(table_stream(spark, log, rows.schema), ["event_id"], "event_ts"), out, state, every=None))
    assert sorted(r["event_id"] for r in read_table(spark, out).collect()) == ["a", "b", "d"]


def test_upsert_over_batches_and_again(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    rows = events(spark, 300)
    for part in (rows.filter("event_id < 200"), rows, rows.unionByName(rows)):
        append_table(part, log)
        stream = table_stream(spark, log, rows.schema, max_files=1)
        run_available(start_upsert(stream, out, str(tmp_path / "state"), ["event_id"], "event_ts", ["user_id"], every=None))
    assert table_difference(rows, read_table(spark, out)).count() == 0
    # a lost checkpoint replays everything and still adds nothing
    again = table_stream(spark, log, rows.schema)
    run_available(start_upsert(again, out, str(tmp_path / "state-2"), ["event_id"], "event_ts", ["user_id"], every=None))
    assert read_table(spark, out).count() == 300


def test_refresh_equals_rebuild(spark):
    rows = events(spark, 2000)
    as_of = T0 + timedelta(hours=3, minutes=7, seconds=13)
    stored = user_features(rows.filter(F.col("event_ts") < F.lit(as_of - timedelta(minutes=31))))
    fresh = refresh_features(stored, rows, as_of, timedelta(minutes=40))
    assert table_difference(user_features(rows), fresh).count() == 0


def test_content_features(spark):
    rows = events(spark, 400)
    out = content_features(rows, trending_from=2.0)
    shares = {}
    for r in rows.collect():
        if r["event_type"] == "share":
            start = r["event_ts"].replace(minute=r["event_ts"].minute // 5 * 5, second=0, microsecond=0)
            shares[(r["content_id"], start)] = shares.get((r["content_id"], start), 0) + 1
    for r in out.collect():
        assert float(r["share_velocity"]) == round(shares.get((r["content_id"], r["window_start"]), 0) / 5, 4)
        assert r["is_trending"] == (float(r["trending_score"]) >= 2.0)
