"""Relational tables over JDBC. The driver jar and the database are the caller's."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a table or ``(select ...) alias``.

    With ``partition_column`` and ``bounds`` the read is split into ranges, so no
    single task pulls the whole table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the lower and upper bound of the column")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def overwrite_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    writers: int = 8,
    batch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace the rows of a relational table but keep the table itself.

    ``writers`` bounds the open connections: Spark coalesces the frame to it.
    """
    df.write.option("truncate", True).option("numPartitions", writers).option("batchsize", batch_rows).jdbc(
        url, table, mode="overwrite", properties=dict(properties or {})
    )
