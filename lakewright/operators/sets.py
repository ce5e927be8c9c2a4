"""Set operations and table comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def union_all(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=allow_missing)
    return first


def shared_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Count, first and last of the distinct values both frames have."""
    both = left.select(column).intersect(right.select(column))
    return both.agg(
        F.count(column).alias("shared"), F.min(column).alias("first_shared"), F.max(column).alias("last_shared")
    )


#: Buckets that table contents are summed up in: the rows that a comparison of equal tables shuffles per task.
BUCKETS = 1024


def _comparable(df: DataFrame, column: str) -> Column:
    """A column as its hash is taken: nested values as JSON, which tells apart what their own hash does not."""
    nested = isinstance(df.schema[column].dataType, (ArrayType, MapType, StructType))
    return F.to_json(F.struct(column), {"ignoreNullFields": "false"}) if nested else F.col(column)


def bucket_sums(sides: DataFrame, names: Sequence[str], buckets: int) -> DataFrame:
    """(_bucket, difference in rows and in two sums of row hashes): order-free checksums of 128 bits per bucket.

    NULLs are hashed by place, so equal values in other columns do not look alike.
    """
    places = [F.col(c).isNull() for c in names]
    values = [_comparable(sides, c) for c in names]
    first, second = F.xxhash64(*values, *places), F.xxhash64(F.lit("second"), *places, *values)
    told = sides.select(F.pmod(first, F.lit(buckets)).alias("_bucket"), first.alias("_h1"), second.alias("_h2"), (F.col("_e") - F.col("_a")).alias("_sign"))

    def signed(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(38,0)") * F.col("_sign"))

    return told.groupBy("_bucket").agg(F.sum("_sign").alias("_n"), signed("_h1").alias("_s1"), signed("_h2").alias("_s2"))


def table_difference(expected: DataFrame, actual: DataFrame, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows the two frames hold in different numbers, with both counts; empty when equal.

    Rows are summed up in ``buckets`` by a hash first, so equal tables shuffle one row per
    bucket and task. Only rows of buckets that differ are grouped, with map-side counts.
    Both frames are read twice.
    """
    names = list(columns or expected.columns)
    sides = expected.select(*names, F.lit(1).alias("_e"), F.lit(0).alias("_a")).unionByName(
        actual.select(*names, F.lit(0).alias("_e"), F.lit(1).alias("_a"))
    )
    differing = bucket_sums(sides, names, buckets).filter("_n <> 0 OR _s1 <> 0 OR _s2 <> 0").select("_bucket")
    bucket = F.pmod(F.xxhash64(*[_comparable(sides, c) for c in names], *[F.col(c).isNull() for c in names]), F.lit(buckets))
    # at most as many rows as there are buckets
    suspect = sides.withColumn("_bucket", bucket).join(F.broadcast(differing), "_bucket", "left_semi")
    return (
        suspect.groupBy(*names)
        .agg(F.sum("_e").alias("expected_rows"), F.sum("_a").alias("actual_rows"))
        .filter(F.col("expected_rows") != F.col("actual_rows"))
    )
