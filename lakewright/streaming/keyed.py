"""Streams of any number of triggers: deduplication against a table by day, late rows kept apart, features of touched days.

State lives in tables, not in memory: the events by day, the late rows and one row of
counts per batch. So a replay needs not fit into one trigger, a batch that runs again
writes what it wrote before, and nothing is dropped without being counted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lakewright.functions.dates import moment
from lakewright.sinks.tables import overwrite_partitions, reused
from lakewright.sources.files import read_table, table_exists
from lakewright.streaming.events import new_events, split_late, touched
from lakewright.streaming.features import EventNames, user_features

DAY, BATCH = "event_day", "batch_id"
EVENTS, LATE, COUNTS = "events", "late", "counts"
_COUNTS = [StructField(name, LongType()) for name in ("n_rows", "n_late", "n_unique")]
#: Called after a batch with the session, the batch's unique rows and its id.
After = Callable[[SparkSession, DataFrame, int], None]


def earlier(spark: SparkSession, path: str, batch_id: int, schema: StructType) -> DataFrame | None:
    """The rows that batches before this one left in a table."""
    return read_table(spark, path, schema).filter(F.col(BATCH) < batch_id) if table_exists(spark, path) else None


def start_unique(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    at: str,
    tie_breakers: Sequence[str],
    delay_minutes: int,
    every: str | None = "30 seconds",
    after: After | None = None,
) -> StreamingQuery:
    """The first of each key to ``root/events`` by day, late rows to ``root/late``, counts to ``root/counts``.

    A row is late if it is older than the newest time of earlier batches by more than
    ``delay_minutes``; it is kept, not dropped. Of the copies in one batch the newest
    counts, of copies in several batches the first. A key's day is that of its time, so a
    batch looks for copies in the days it falls into only. Rows without a time share a
    day of their own and are never late. Counts are written last: rows, late, unique.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark, kind = batch.sparkSession, batch.schema[at].dataType
        told = StructType([*_COUNTS, StructField("newest", kind), StructField(BATCH, IntegerType())])
        seen = earlier(spark, f"{root}/{COUNTS}", batch_id, told)
        # one row per batch; as text, so that no time zone but the session's is involved
        newest = seen.agg(F.max("newest").cast("string")).first()[0] if seen is not None else None
        with reused(batch.withColumn(DAY, F.to_date(at))) as rows:
            on_time, late = split_late(rows, at, F.lit(newest).cast(kind), delay_minutes)
            schema = StructType([*rows.schema, StructField(BATCH, IntegerType())])
            fresh = new_events(earlier(spark, f"{root}/{EVENTS}", batch_id, schema), on_time, keys, at, tie_breakers, [DAY])
            overwrite_partitions(fresh.withColumn(BATCH, F.lit(batch_id)), f"{root}/{EVENTS}", [DAY, BATCH])
            overwrite_partitions(late.withColumn(BATCH, F.lit(batch_id)), f"{root}/{LATE}", [BATCH])
            unique = read_table(spark, f"{root}/{EVENTS}", schema).filter(F.col(BATCH) == batch_id)
            if after is not None:
                after(spark, unique, batch_id)
            is_late = late.agg(F.count(F.lit(1)).alias("n")).scalar()
            counts = rows.agg(
                F.count(F.lit(1)).alias("n_rows"), is_late.alias("n_late"), F.lit(unique.count()).cast("long").alias("n_unique"), F.max(at).alias("newest")
            ).withColumn(BATCH, F.lit(batch_id))
            overwrite_partitions(counts, f"{root}/{COUNTS}", [BATCH])

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(work)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Rows, unique rows, copies and late rows over all batches, however many there were."""
    return read_table(spark, f"{root}/{COUNTS}").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_unique"), F.lit(0)).alias("n_unique"),
        F.coalesce(F.sum("n_late"), F.lit(0)).alias("n_late"),
        F.coalesce(F.sum(F.col("n_rows") - F.col("n_late") - F.col("n_unique")), F.lit(0)).alias("n_copies"),
    )


def refresh_days(
    spark: SparkSession, events_path: str, features_path: str, arrived: DataFrame, as_of: datetime,
    at: str = "event_ts", user: str = "user_id", width: str = "5 minutes", names: EventNames = EventNames(),
) -> None:
    """Compute the features of the days that ``arrived`` falls into anew, and replace those days only.

    An event updates its window however late it comes. Windows of a width that divides
    the day never cross midnight. ``created_at`` is the time of the refresh that made a row.
    """
    rows = read_table(spark, events_path).filter(touched(arrived, [DAY])).filter(F.col(at).isNotNull())
    features = user_features(rows, at, user, width, names=names)
    dated = features.withColumns({"created_at": moment(as_of, "timestamp"), DAY: F.to_date("window_start")})
    overwrite_partitions(dated, features_path, [DAY])
