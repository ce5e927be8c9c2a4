"""Message parsing and the append sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakewright.functions.text import decoded, parsed
from lakewright.operators.projections import flatten_struct

# Names the message envelope gets in the raw event table.
ENVELOPE = {
    "partition": "_kafka_partition",
    "offset": "_kafka_offset",
    "timestamp": "_kafka_timestamp",
}
LOADED_AT = "_bronze_loaded_at"


def parse_messages(messages: DataFrame, schema: StructType, keep: Mapping[str, str] | None = None) -> DataFrame:
    """Message bytes -> event columns plus the kept envelope columns. Batch or streaming."""
    kept = ENVELOPE if keep is None else keep
    events = messages.select(parsed(decoded(F.col("value")), schema).alias("event"), *kept)
    return flatten_struct(events, "event", kept)


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "30 seconds",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a table. ``every=None`` takes all that is available and stops."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


class RowsRefused(RuntimeError):
    """A watermark refused rows as too late."""


def refused_rows(query: StreamingQuery) -> int:
    """Rows that stateful operators have refused as older than the watermark, over the triggers still recorded."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def run_available(query: StreamingQuery, all_rows: bool = False) -> None:
    """Wait for an available-now query and surface its failure; with ``all_rows`` also rows that a watermark refused."""
    query.awaitTermination()
    if all_rows and (refused := refused_rows(query)):
        raise RowsRefused(f"{refused} rows were older than the watermark; replay in order of event time or in one trigger")
