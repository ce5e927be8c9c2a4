"""Query registry and table access."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as doubles, instants as plain timestamps.

    Both engines then hand Python the same kinds of value.
    """
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, DateType):
            casts[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL twin."""

    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query '{name}' is registered twice")

        @wraps(run)
        def portable_run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(run(spark, sf_dir))

        ENTRIES[name] = Entry(name, portable_run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
