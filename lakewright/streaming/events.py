"""Event cleaning shared by batch and stream, deduplication and late data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewright.functions.classify import MOBILE_DEVICES, VIRAL_CONTENT, in_codes
from lakewright.functions.dates import iso_timestamp
from lakewright.functions.text import trimmed
from lakewright.operators.aggregates import conjunction
from lakewright.operators.filters import has_keys, split_valid
from lakewright.operators.incremental import rows_to_insert
from lakewright.operators.projections import drop_present
from lakewright.operators.windows import keep_latest
from lakewright.sinks.tables import append_table, compact_partitions, reused
from lakewright.sources.files import read_table, table_exists
from lakewright.streaming.ingest import ENVELOPE, LOADED_AT

# Accepted event and content kinds, and the columns an event must have.
EVENT_TYPES = ("like", "share", "comment", "impression", "watch", "save")
CONTENT_TYPES = ("video", "image", "text", "reel")
EVENT_KEYS = ("event_id", "user_id", "content_id", "event_type")
WATERMARK = "10 minutes"


def event_rules(event_types: Sequence[str] = EVENT_TYPES, content_types: Sequence[str] = CONTENT_TYPES) -> dict[str, Column]:
    """What a good event meets, by rule name."""
    return {
        **{f"missing {key}": F.col(key).isNotNull() for key in EVENT_KEYS},
        "missing event_ts": F.col("event_ts").isNotNull(),
        "unknown event_type": F.col("event_type").isin(*event_types),
        "unknown content_type": F.col("content_type").isin(*content_types),
    }


def typed_events(events: DataFrame, trim: Sequence[str] = ()) -> DataFrame:
    """Event time as a timestamp, chosen text columns trimmed."""
    columns = trimmed(trim)
    columns["event_ts"] = iso_timestamp(F.col("event_ts")) if dict(events.dtypes)["event_ts"] == "string" else F.col("event_ts")
    return events.withColumns(columns)


def flagged_events(events: DataFrame) -> DataFrame:
    """Hour, mobile and viral-content columns; message metadata dropped."""
    return drop_present(
        events.withColumns(
            {
                "event_hour": F.hour("event_ts"),
                "is_mobile": in_codes(F.col("device_type"), MOBILE_DEVICES),
                "is_viral_content_type": in_codes(F.col("content_type"), VIRAL_CONTENT),
            }
        ),
        [*ENVELOPE.values(), LOADED_AT],
    )


def clean_events(
    events: DataFrame,
    event_types: Sequence[str] = EVENT_TYPES,
    content_types: Sequence[str] = CONTENT_TYPES,
    trim: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Typed, valid, flagged events; the same code for a batch and a stream."""
    typed = typed_events(events, trim)
    if watermark:
        typed = typed.withWatermark("event_ts", watermark)
    valid = has_keys(typed, [*EVENT_KEYS, "event_ts"]).filter(
        F.col("event_type").isin(*event_types) & F.col("content_type").isin(*content_types)
    )
    return flagged_events(valid)


def route_events(
    events: DataFrame,
    event_types: Sequence[str] = EVENT_TYPES,
    content_types: Sequence[str] = CONTENT_TYPES,
    trim: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(clean events, rejected events with a reason)."""
    valid, rejected = split_valid(typed_events(events, trim), event_rules(event_types, content_types))
    return flagged_events(valid), rejected


def first_of_each(stream: DataFrame, keys: Sequence[str], at: str, watermark: str = WATERMARK) -> DataFrame:
    """Streaming dedup: one row per key while the watermark keeps it; later rows are dropped."""
    return stream.withWatermark(at, watermark).dropDuplicatesWithinWatermark(list(keys))


def touched(batch: DataFrame, columns: Sequence[str]) -> Column:
    """A filter on the values of ``columns`` that a batch has: as many as the partitions it falls into, such as days.

    A literal filter, so the table's other partitions are not even listed as input.
    """
    rows = batch.select(*columns).distinct().collect()
    if len(columns) == 1:
        values = [r[0] for r in rows if r[0] is not None]
        found = F.col(columns[0]).isin(values)
        return found | F.col(columns[0]).isNull() if len(values) < len(rows) else found
    each = [conjunction([F.col(c).eqNullSafe(F.lit(r[c])) for c in columns]) for r in rows]
    return reduce(lambda x, y: x | y, each, F.lit(False))


def new_events(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str], order_by: str, tie_breakers: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Batch rows whose key the table lacks, one per key.

    ``within`` are partition columns that a key determines, such as the day of an event:
    only the partitions that the batch falls into are read, and of those the key columns.
    Which side moves is left to Spark, which knows the stored batch's size.
    """
    if existing is None:
        return keep_latest(batch, keys, order_by, tie_breakers)
    there = existing.filter(touched(batch, within)) if within else existing
    stored = there.select(*keys).join(batch.select(*keys).distinct(), list(keys), "left_semi")
    return rows_to_insert(stored, batch, keys, order_by, tie_breakers)


def start_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: str,
    tie_breakers: Sequence[str],
    partition_by: Sequence[str] = (),
    every: str | None = "30 seconds",
    compact_every: int | None = None,
) -> StreamingQuery:
    """Insert-if-absent of each micro-batch; running a batch twice adds nothing.

    ``partition_by`` are columns that a key determines; a batch then reads and writes its
    own partitions only. Every ``compact_every`` batches the small files of a partition
    that this batch falls into become few.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with reused(batch) as kept:
            existing = read_table(spark, path) if table_exists(spark, path) else None
            fresh = new_events(existing, kept, keys, order_by, tie_breakers, partition_by)
            append_table(fresh, path, partition_by)
            if compact_every and partition_by and batch_id % compact_every == compact_every - 1:
                compact_partitions(spark, path, partition_by, touched(kept, partition_by))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def start_routed(
    stream: DataFrame,
    outputs: Mapping[str, str],
    checkpoint: str,
    route: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    every: str | None = "30 seconds",
) -> StreamingQuery:
    """Append good rows to ``outputs['valid']`` and rejected ones to ``outputs['rejected']``.

    Each batch goes to a folder named after its id and replaces it, so a batch
    that is run again after a failure leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with reused(batch) as kept:
            for name, frame in zip(("valid", "rejected"), route(kept), strict=True):
                frame.write.mode("overwrite").parquet(f"{outputs[name]}/batch_id={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def split_late(events: DataFrame, at: str, newest_seen: Column, delay_minutes: int = 10) -> tuple[DataFrame, DataFrame]:
    """(on time, late): late rows are older than the newest time seen so far minus the delay."""
    limit = newest_seen - F.make_dt_interval(mins=F.lit(delay_minutes))
    late = F.coalesce(F.col(at) < limit, F.lit(False))
    return events.filter(~late), events.filter(late)
