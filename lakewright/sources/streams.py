"""Streaming readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def message_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int = 10_000,
    fail_on_loss: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rate-limited stream of (key, value, topic, partition, offset, timestamp).

    Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("failOnDataLoss", str(fail_on_loss).lower())
    )
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = 10,
    glob: str | None = None,
) -> DataFrame:
    """Stream of the files that land in a table folder, ``max_files`` per trigger.

    Files are taken in the order in which they landed. Where event times follow no such
    order, as in a replay of a stored table, a watermark would refuse what comes in a
    later trigger than newer rows; ``max_files=None`` takes all files in one.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
