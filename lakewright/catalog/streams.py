"""Streams run to the end of their input; each gives what a batch over the same rows gives."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.catalog.sources import FEATURES, NAMES
from lakewright.plans.engagement import EVENT_SCHEMA
from lakewright.session import scratch_path
from lakewright.sinks.tables import append_table
from lakewright.sources.files import read_table
from lakewright.sources.streams import table_stream
from lakewright.streaming.events import clean_events, first_of_each, route_events, split_late, start_routed
from lakewright.streaming.features import content_features, user_features
from lakewright.streaming.keyed import DAY, EVENTS, refresh_days, start_unique
from lakewright.streaming.ingest import parse_messages, run_available, start_append


def stored_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table, one file or a folder of files, as a stream; in one trigger, as its files follow no order of time."""
    stored = table(spark, sf, name)
    in_folder = any(file.rsplit("/", 2)[-2] == f"{name}.parquet" for file in stored.inputFiles()[:1])
    if in_folder:
        return table_stream(spark, f"{sf}/{name}.parquet", stored.schema, max_files=None)
    return table_stream(spark, sf, stored.schema, max_files=None, glob=f"{name}.parquet")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream; event time as an instant, as watermarks need."""
    stream = stored_stream(spark, sf, "events")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    out = scratch_path(spark, f"{label}-out")
    run_available(start_append(stream, out, scratch_path(spark, f"{label}-state"), every=None), all_rows=True)
    return read_table(spark, out)


@query(
    "str_01_message_ingest",
    f"""WITH {s.ENGAGEMENT} SELECT event_id, event_type, user_id, content_id, platform, event_ts, watch_duration FROM engagement""",
)
def message_ingest(spark: SparkSession, sf: str) -> DataFrame:
    log = s.message_log(spark, sf, "ingest")
    raw = run_to_table(parse_messages(table_stream(spark, log, read_table(spark, log).schema), EVENT_SCHEMA), "ingest")
    columns = ["event_id", "event_type", "user_id", "content_id", "platform", F.try_to_timestamp("event_ts").alias("event_ts"), "watch_duration"]
    return raw.select(*columns)


# The closing row: windows are given out once the watermark has passed them,
# so the newest windows stay open until later events arrive.
CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"
FEATURE_COLUMNS = "user_id, window_start, window_end, total_likes, total_shares, total_comments, total_impressions, engagement_score, content_virality"


@query("str_02_watermarked_features", f"WITH {FEATURES.format(width='5 minutes')} SELECT {FEATURE_COLUMNS} FROM scored WHERE {CLOSED}")
def watermarked_features(spark: SparkSession, sf: str) -> DataFrame:
    """Append mode gives each window once, after its watermark; the windows still open are not in the result."""
    stream = user_features(event_stream(spark, sf), "ts", watermark="10 minutes", names=NAMES)
    return run_to_table(stream, "features")


@query("str_02_features_in_many_triggers", f"WITH {FEATURES.format(width='5 minutes')} SELECT {FEATURE_COLUMNS} FROM scored")
def features_in_many_triggers(spark: SparkSession, sf: str) -> DataFrame:
    """Files in no order of time, a few a trigger, and each event twice: every trigger refreshes the days it falls into."""
    log, root = scratch_path(spark, "keyed-log"), scratch_path(spark, "keyed")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    events.unionByName(events).repartition("event_id").write.option("maxRecordsPerFile", 500_000).parquet(log)

    def refresh(session: SparkSession, unique: DataFrame, batch_id: int) -> None:
        refresh_days(session, f"{root}/{EVENTS}", f"{root}/features", unique, datetime(2025, 1, 1), at="ts", names=NAMES)

    a_year = 366 * 24 * 60
    stream = table_stream(spark, log, events.schema, max_files=4)
    run_available(start_unique(stream, root, scratch_path(spark, "keyed-state"), ["event_id"], "ts", ["user_id"], a_year, every=None, after=refresh))
    return read_table(spark, f"{root}/features").drop("created_at", DAY)


@query(
    "str_03_late_rows_routed",
    """WITH newest AS (SELECT max(ts) AS t FROM events WHERE event_type = 'click')
       SELECT ts >= t - INTERVAL '10 minutes' AS on_time, count(*) AS n_rows, min(event_id) AS first_id FROM events, newest GROUP BY 1""",
)
def late_rows_routed(spark: SparkSession, sf: str) -> DataFrame:
    """With the clicks seen, every row older than their newest time minus the delay counts as late."""
    events = table(spark, sf, "events")
    newest = events.filter(F.col("event_type") == "click").agg(F.max("ts").alias("t")).scalar()
    on_time, late = split_late(events, "ts", newest, 10)
    both = on_time.withColumn("on_time", F.lit(True)).unionByName(late.withColumn("on_time", F.lit(False)))
    return both.groupBy("on_time").agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"))


@query(
    "str_03_rejects_routed",
    f"""WITH {s.ENGAGEMENT} SELECT CASE WHEN user_id IS NULL THEN 'missing user_id'
          WHEN event_type NOT IN ('like', 'share', 'comment', 'impression', 'watch', 'save') THEN 'unknown event_type'
          WHEN content_type NOT IN ('video', 'image', 'text', 'reel') THEN 'unknown content_type' ELSE 'valid' END AS reason,
          count(*) AS n_rows FROM engagement GROUP BY 1""",
)
def rejects_routed(spark: SparkSession, sf: str) -> DataFrame:
    """Each micro-batch writes its good rows and its dead letters."""
    log = s.message_log(spark, sf, "routed")
    outputs = {name: scratch_path(spark, f"routed-{name}") for name in ("valid", "rejected")}
    stream = parse_messages(table_stream(spark, log, read_table(spark, log).schema), EVENT_SCHEMA)
    run_available(start_routed(stream, outputs, scratch_path(spark, "routed-state"), route_events, every=None))
    valid = read_table(spark, outputs["valid"]).select(F.lit("valid").alias("reason"))
    rejected = read_table(spark, outputs["rejected"]).select(F.col("_reject_reason").alias("reason"))
    return valid.unionByName(rejected).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "str_04_stream_dedup",
    f"WITH {s.ENGAGEMENT_ONCE} SELECT event_id, event_type, user_id, event_ts FROM engagement_once WHERE {s.GOOD_EVENT}",
)
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Shares arrive twice; state keyed by event keeps the first."""
    log = s.message_log(spark, sf, "dedup")
    stream = clean_events(parse_messages(table_stream(spark, log, read_table(spark, log).schema, max_files=None), EVENT_SCHEMA))
    unique = first_of_each(stream, ["event_id"], "event_ts")
    return run_to_table(unique, "dedup").select("event_id", "event_type", "user_id", "event_ts")


@query(
    "str_05_clean_and_enrich",
    f"WITH {s.ENGAGEMENT} SELECT event_id, event_type, content_type, device_type, event_ts, {s.EVENT_FLAGS} FROM engagement WHERE {s.GOOD_EVENT}",
)
def clean_and_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """The batch form of the cleaning that the streams use."""
    events = parse_messages(s.engagement_messages(spark, sf), EVENT_SCHEMA)
    return clean_events(events, trim=["platform", "device_type"]).select(
        "event_id", "event_type", "content_type", "device_type", "event_ts", "event_hour", "is_mobile", "is_viral_content_type"
    )


@query("str_06_user_features", f"WITH {FEATURES.format(width='5 minutes')} SELECT {FEATURE_COLUMNS} FROM scored")
def batch_features(spark: SparkSession, sf: str) -> DataFrame:
    return user_features(table(spark, sf, "events"), "ts", names=NAMES)


CONTENT = """WITH c AS (
  SELECT 'c' || regexp_extract(props, '([0-9]+)', 1) AS content_id, time_bucket(INTERVAL '60 minutes', ts) AS window_start,
         count(*) FILTER (WHERE event_type IN ('click', 'purchase', 'signup')) AS reaction_count,
         count(*) FILTER (WHERE event_type = 'purchase') AS shares, count(*) FILTER (WHERE event_type = 'signup') AS comments,
         count(*) FILTER (WHERE event_type = 'click') AS likes
  FROM events GROUP BY 1, 2)
SELECT content_id, window_start, window_start + INTERVAL '60 minutes' AS window_end, reaction_count,
       round((shares / 60.0::double)::decimal(38,10), 4)::double AS share_velocity,
       round(((shares * 4 + comments * 3 + likes * 2) / 60.0::double)::decimal(38,10), 4) >= 0.1 AS is_trending,
       round(((shares * 4 + comments * 3 + likes * 2) / 60.0::double)::decimal(38,10), 4)::double AS trending_score FROM c"""


@query("str_07_content_features", CONTENT)
def trending_content(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("content_id", F.concat(F.lit("c"), F.regexp_extract("props", "([0-9]+)", 1)))
    return content_features(events, "ts", width_minutes=60, names=NAMES, trending_from=0.1)


@query("str_08_restart_from_checkpoint", "SELECT event_id, user_id, event_type FROM events")
def restart(spark: SparkSession, sf: str) -> DataFrame:
    """Run, let more files land, run again on the same checkpoint: every row once."""
    log, out, state = (scratch_path(spark, f"restart-{n}") for n in ("log", "out", "state"))
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    for part in (F.col("event_type") != "click", F.col("event_type") == "click"):
        append_table(events.filter(part), log)
        run_available(start_append(table_stream(spark, log, events.schema, max_files=1), out, state, every=None))
    return read_table(spark, out)


@query(
    "str_09_bounded_batches",
    """SELECT event_type, count(*) AS n_rows, sum(value::decimal(18,2))::double AS total FROM events GROUP BY 1""",
)
def bounded_batches(spark: SparkSession, sf: str) -> DataFrame:
    """One file per trigger, and files of a bounded number of rows, however long the log is."""
    log = scratch_path(spark, "bounded-log")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    events.write.option("maxRecordsPerFile", 20_000).parquet(log)
    stored = run_to_table(table_stream(spark, log, events.schema, max_files=1), "bounded")
    return stored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )


