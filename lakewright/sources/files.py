"""Delimited files and path-addressed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column a string; empty cells are NULL, a BOM is ignored."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("nullValue", "")
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    timestamps: Mapping[str, str] | None = None,
    sep: str = ",",
    quote: str = '"',
) -> DataFrame:
    """Delimited file with a declared schema.

    ``timestamps`` maps a column to the text format it arrives in; such columns
    are read as text and parsed, so an unreadable value becomes NULL.
    """
    formats = dict(timestamps or {})
    arriving = StructType(
        [StructField(f.name, StringType()) if f.name in formats else f for f in schema.fields]
    )
    raw = (
        spark.read.schema(arriving)
        .option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    parsed = {
        name: F.try_to_timestamp(F.col(name), F.lit(fmt)).cast(schema[name].dataType)
        for name, fmt in formats.items()
    }
    return raw.withColumns(parsed) if parsed else raw


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Columnar table addressed by its folder.

    A schema keeps the types of partition columns, whose folder names would
    otherwise be read as numbers (``01`` as 1) or text (``true``).
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds at least one entry, on any file system Spark can reach."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path)) and len(fs.listStatus(jvm_path)) > 0
