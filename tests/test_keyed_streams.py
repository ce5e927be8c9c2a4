"""Streams of many triggers: nothing lost uncounted, copies found by day, days refreshed."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakewright.operators.sets import table_difference
from lakewright.sinks.tables import append_table, compact_partitions
from lakewright.sources.files import read_table
from lakewright.sources.streams import table_stream
from lakewright.streaming.events import new_events, start_upsert
from lakewright.streaming.features import user_features
from lakewright.streaming.ingest import run_available
from lakewright.streaming.keyed import DAY, refresh_days, start_unique, totals

SCHEMA = "event_id string, user_id string, event_type string, event_ts timestamp"
T0 = datetime(2026, 1, 1)


def rows(n, rng):
    """Events of eight days, a third of them of one user, some twice or without a time."""
    made = []
    for k in range(n):
        at = None if k % 97 == 0 else T0 + timedelta(seconds=rng.randrange(8 * 86400))
        made.append((str(k), "star" if k % 3 == 0 else f"u{k % 11}", rng.choice(["like", "share", "comment", "impression"]), at))
    return made + made[: n // 5]


def land(spark, path, made, files):
    for k in range(files):
        append_table(spark.createDataFrame(made[k::files], SCHEMA).coalesce(1), path)


@pytest.mark.parametrize("files, per_trigger", [(1, 1), (12, 5), (24, 8)])
def test_unique_copies_and_late_add_up(spark, tmp_path, files, per_trigger):
    rng = random.Random(files)
    made = rows(600, rng)
    rng.shuffle(made)
    log, root = str(tmp_path / "log"), str(tmp_path / "out")
    land(spark, log, made, files)

    def run(state):
        stream = table_stream(spark, log, spark.createDataFrame([], SCHEMA).schema, max_files=per_trigger)
        run_available(start_unique(stream, root, str(tmp_path / state), ["event_id"], "event_ts", ["user_id"], 24 * 60, every=None))

    run("state")
    told = totals(spark, root).first()
    events = read_table(spark, f"{root}/events")
    assert told.n_rows == len(made) == told.n_unique + told.n_copies + told.n_late
    assert events.count() == told.n_unique == events.select("event_id").distinct().count()
    if files == 1:
        assert told.n_late == 0 and told.n_unique == 600
    else:
        late = read_table(spark, f"{root}/late")
        assert late.count() == told.n_late > 0
        found = events.select("event_id").union(late.select("event_id")).distinct().count()
        assert found == 600
    # a lost checkpoint replays all batches, which write what they wrote
    run("state-2")
    again = totals(spark, root).first()
    assert again.n_rows == told.n_rows == again.n_unique + again.n_copies + again.n_late


def test_more_triggers_than_spark_remembers_are_counted(spark, tmp_path):
    made = [(str(k), "u", "like", T0 + timedelta(days=(k * 7) % 5)) for k in range(24)]
    log, root = str(tmp_path / "log"), str(tmp_path / "out")
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(log)
    stream = table_stream(spark, log, spark.createDataFrame([], SCHEMA).schema, max_files=1)
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(remembered)
    spark.conf.set(remembered, "5")
    try:
        query = start_unique(stream, root, str(tmp_path / "state"), ["event_id"], "event_ts", ["user_id"], 60, every=None)
        run_available(query)
        assert len(query.recentProgress) <= 5
    finally:
        spark.conf.set(remembered, before)
    told = totals(spark, root).first()
    assert read_table(spark, f"{root}/counts").count() == 24
    assert told.n_rows == 24 == told.n_unique + told.n_late and told.n_late == read_table(spark, f"{root}/late").count() > 0


def test_a_late_event_updates_its_window_and_no_other_day(spark, tmp_path):
    made = rows(300, random.Random(1))
    log, root = str(tmp_path / "log"), str(tmp_path / "out")
    land(spark, log, made, 1)
    stamp = [datetime(2026, 2, 1), datetime(2026, 2, 2)]

    def run(n):
        def after(session, unique, batch_id):
            refresh_days(session, f"{root}/events", f"{root}/features", unique, stamp[n])

        stream = table_stream(spark, log, spark.createDataFrame([], SCHEMA).schema)
        run_available(
            start_unique(stream, root, str(tmp_path / "state"), ["event_id"], "event_ts", ["user_id"], 10 * 24 * 60, every=None, after=after)
        )

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "out" / "features").glob(f"{DAY}=*/*.parquet")}

    run(0)
    before = files()
    late = [("late", "star", "share", T0 + timedelta(days=2, hours=3))]
    land(spark, log, late, 1)
    run(1)
    after = files()
    kept = {f for f in before if f"{DAY}=2026-01-03" not in f}
    assert {f: after[f] for f in kept} == {f: before[f] for f in kept} and len(kept) >= 7 and set(after) != set(before)
    features = read_table(spark, f"{root}/features")
    whole = spark.createDataFrame(made + late, SCHEMA).dropDuplicates(["event_id"]).filter("event_ts IS NOT NULL")
    assert table_difference(user_features(whole), features.drop("created_at", DAY)).count() == 0
    assert {r[DAY].day for r in features.filter(F.col("created_at") == F.lit(stamp[1])).select(DAY).distinct().collect()} == {3}


def test_an_upsert_reads_the_days_of_its_batch(spark, tmp_path):
    made = [(k, d) for k, d, in ((r[0], r[3]) for r in rows(200, random.Random(2)))]
    table = spark.createDataFrame(made, "event_id string, event_ts timestamp").dropDuplicates(["event_id"]).withColumn(DAY, F.to_date("event_ts"))
    path = str(tmp_path / "table")
    append_table(table, path, [DAY])
    for ts in (T0, None):
        batch = spark.createDataFrame([("1", ts), ("new", ts), ("new", ts)], "event_id string, event_ts timestamp").withColumn(DAY, F.to_date("event_ts"))
        fresh = new_events(read_table(spark, path), batch, ["event_id"], "event_ts", [DAY], [DAY])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
        assert filters and all(("2026-01-01" in line) if ts else ("isnull(event_day" in line) for line in filters)
        assert all("ReadSchema: struct<event_id:string>" in line for line in filters)
        assert {r.event_id for r in fresh.collect()} <= {"1", "new"}


@pytest.mark.parametrize("batches", [1, 12])
def test_upserts_over_many_batches_with_compaction(spark, tmp_path, batches):
    made = rows(400, random.Random(3))
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    land(spark, log, made, batches)
    stream = table_stream(spark, log, spark.createDataFrame([], SCHEMA).schema, max_files=1).withColumn(DAY, F.to_date("event_ts"))
    run_available(
        start_upsert(stream, out, str(tmp_path / "state"), ["event_id"], "event_ts", ["user_id"], [DAY], every=None, compact_every=5)
    )
    expected = spark.createDataFrame(made, SCHEMA).dropDuplicates(["event_id"])
    assert table_difference(expected, read_table(spark, out).drop(DAY)).count() == 0
    compact_partitions(spark, out, [DAY], F.lit(True))
    assert len(list((tmp_path / "out").glob(f"{DAY}=*/*.parquet"))) == 9
    assert table_difference(expected, read_table(spark, out).drop(DAY)).count() == 0
