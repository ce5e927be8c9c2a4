"""Engagement events: schema, clean table and user features."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from lakewright.functions.dates import moment
from lakewright.operators.incremental import insert_if_absent, lookback_start, merge_by_key
from lakewright.operators.windows import keep_latest
from lakewright.streaming.events import clean_events
from lakewright.streaming.features import EventNames, user_features

# Fields of an event message, in order.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("event_type", StringType(), False),
        StructField("user_id", StringType(), False),
        StructField("content_id", StringType(), False),
        StructField("content_type", StringType(), False),
        StructField("creator_id", StringType(), False),
        StructField("device_type", StringType(), False),
        StructField("platform", StringType(), False),
        StructField("event_ts", StringType(), False),
        StructField("ingestion_ts", StringType(), False),
        StructField("session_id", StringType(), False),
        StructField("watch_duration", DoubleType(), True),
        StructField("comment_length", IntegerType(), True),
    ]
)


ORDER = ["ingestion_ts", "user_id", "content_id", "session_id"]


def clean_table(existing: DataFrame | None, raw: DataFrame) -> DataFrame:
    """Clean events by id: stored rows stay, of several new copies the newest is added."""
    fresh = clean_events(raw)
    if existing is None:
        return keep_latest(fresh, ["event_id"], "event_ts", ORDER)
    return insert_if_absent(existing, fresh, ["event_id"], "event_ts", ORDER)


def event_view(clean: DataFrame) -> DataFrame:
    """Typed view of the clean table; rows without an event time are left out."""
    typed = clean.withColumns(
        {
            "event_ts": F.col("event_ts").try_cast("timestamp"),
            "ingestion_ts": F.col("ingestion_ts").try_cast("timestamp"),
        }
    )
    return typed.filter(F.col("event_ts").isNotNull())


def refresh_features(
    features: DataFrame,
    events: DataFrame,
    as_of: datetime,
    lookback: timedelta = timedelta(hours=2),
    width: timedelta = timedelta(minutes=5),
    at: str = "event_ts",
    user: str = "user_id",
    names: EventNames = EventNames(),
) -> DataFrame:
    """Recompute the windows of the last ``lookback`` and merge them by user and window."""
    start = lookback_start(as_of, lookback, width)
    edge = moment(start, events.schema[at].dataType)
    recent = events.filter(F.col(at) >= edge)
    fresh = user_features(recent, at, user, f"{int(width.total_seconds())} seconds", names=names)
    return merge_by_key(features, fresh, [user, "window_start"], F.col("window_start") >= edge)
