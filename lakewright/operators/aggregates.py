"""Aggregations. Everything here keeps a bounded state per group and combines before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, FractionalType, IntegralType, StringType, TimestampNTZType, TimestampType

from lakewright.functions.keys import compact
from lakewright.functions.numbers import to_number
from lakewright.session import stored

#: Types of values that the frequency sketch takes.
SKETCHED = (StringType, IntegralType, FractionalType, DateType, TimestampType, TimestampNTZType, BooleanType)


def counted(df: DataFrame, conditions: Mapping[str, Column], total: str = "total_rows") -> DataFrame:
    """Row count and several conditional counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(cond).alias(name) for name, cond in conditions.items()]
    )


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def rows_per_key(df: DataFrame, keys: Sequence[str], name: str = "_n") -> DataFrame:
    """Row count of each key, where only the counts matter: long texts are compared by hash."""
    kinds = dict(df.dtypes)
    short = [(compact(F.col(k)) if kinds[k] == "string" else F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    return df.groupBy(*short).agg(F.count(F.lit(1)).alias(name))


def counts_by(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Conditional counts per group."""
    return df.groupBy(*keys).agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the difference. NULL parts count as values."""
    return rows_per_key(df, keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: NULLs, rows and their ratio, from one scan."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"), F.col("_total").alias("total_rows"))
            for i, c in enumerate(columns)
        ]
    )
    return (
        wide.select(F.explode(rows).alias("_r"))
        .select("_r.*")
        .withColumn("null_rate", F.try_divide(F.col("null_count").cast("double"), F.col("total_rows").cast("double")))
    )


def dirty_number_stats(df: DataFrame, column: str) -> DataFrame:
    """Min, max, mean and unreadable count of numbers kept as text."""
    number = to_number(F.col(column))
    return df.agg(
        F.min(number).alias("min_value"),
        F.max(number).alias("max_value"),
        F.avg(number).alias("mean_value"),
        F.count_if(number.isNull()).alias("null_count"),
    )


def top_values(df: DataFrame, column: str, n: int = 15, tracked: int = 10_000) -> DataFrame:
    """Most frequent values with their exact counts; NULL is a value.

    A frequency sketch of ``tracked`` values per task names candidates and bounds what any
    other value can count; the candidates alone are then counted exactly, so distinct
    values do not move. If the ``n``-th candidate does not exceed the bound, as in a column
    without frequent values, all values are counted. Starts the jobs that decide this.
    """
    whole = group_counts(df, [column])
    if not isinstance(df.schema[column].dataType, SKETCHED):
        return _top(whole, column, n)
    asked = 10 * n
    sketch = F.expr(f"approx_top_k(`{column}`, {asked}, {max(tracked, asked)})")
    told = stored(df.agg(F.count(F.lit(1)).alias("rows"), sketch.alias("items")), "frequent-items")
    # at most ``asked`` rows
    items = told.select(F.explode("items").alias("_i")).select(F.col("_i.item").alias("_item"), F.col("_i.count").alias("_most"))
    seen = told.select("rows", F.size("items").alias("size"), F.array_min("items.count").alias("least")).first()
    # an untracked value counts up to 3.5 rows in ``tracked``, one that was left out as doubtful twice as much
    bound = 7 * seen["rows"] / max(tracked, asked)
    if seen["size"] >= asked:
        bound = max(bound, seen["least"])
    counts = group_counts(df.join(F.broadcast(items.select("_item")), F.col(column).eqNullSafe(F.col("_item")), "left_semi"), [column])
    top = stored(_top(counts, column, n), "frequent-values")
    last = top.agg(F.count(F.lit(1)).alias("n"), F.min("n_rows").alias("least")).first()
    sure = bound < 1 or (last["n"] == n and last["least"] > bound)
    return _top(top if sure else whole, column, n)


def _top(counts: DataFrame, column: str, n: int) -> DataFrame:
    return counts.orderBy(F.desc("n_rows"), F.asc(column)).limit(n)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; the last bin is closed.

    Only bins with rows appear. The bounds are scalar subqueries of the same plan. NULL,
    NaN and infinities are in no bin; a column with one value has bin 0 alone, from the
    value to itself.
    """
    kind = df.schema[column].dataType.typeName()
    if kind in ("double", "float"):
        df = df.filter(~F.isnan(column) & (F.abs(column) < F.lit(float("inf"))))
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    low = bounds.select("lo").scalar()
    high = bounds.select("hi").scalar()
    value = F.col(column)
    width = (high - low) / F.lit(bins)
    place = F.floor(F.try_divide(value - low, width))
    bin_no = F.when(high == low, F.lit(0)).otherwise(F.least(place, F.lit(bins - 1))).cast("int")
    return (
        df.filter(value.isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("bin_start", low + F.col("bin") * width)
        .withColumn("bin_end", low + (F.col("bin") + 1) * width)
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, NULL share, and up to three sample values.

    Samples are the smallest value, the largest, and the one whose hash is
    smallest, so each column keeps a constant state and one scan does it all.
    """

    def samples(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.array_distinct(F.array_compact(F.array(F.min(text), F.min_by(text, F.md5(text)), F.max(text))))

    parts: list[Column] = [F.count(F.lit(1)).alias("_total")]
    for i, field in enumerate(df.schema.fields):
        parts.append(F.count_if(F.col(field.name).isNull()).alias(f"_n{i}"))
        parts.append(samples(field.name).alias(f"_s{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("_total").alias("total_rows"),
                F.col(f"_n{i}").alias("null_count"),
                F.col(f"_s{i}").alias("samples"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(*parts)
        .select(F.explode(rows).alias("_r"))
        .select("_r.*")
        .withColumn(
            "null_pct", F.try_divide(F.col("null_count") * F.lit(100.0), F.col("total_rows").cast("double"))
        )
    )


def value_listing(df: DataFrame, up_to: int = 20) -> DataFrame:
    """Every value, with its count, of the columns that have at most ``up_to`` distinct ones.

    A first scan estimates distinct counts (one row of sketches comes back to the
    driver) and drops the columns that are clearly above; a second counts only
    the columns left, and the exact limit is applied to those counts.
    """
    names = df.columns
    estimate = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in names]).first()
    kept = [c for c in names if estimate[c] <= up_to * 1.5 + 5]
    if not kept:
        kept = names[:0]
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in kept]
    ) if kept else F.array().cast("array<struct<column_name:string,value:string>>")
    counts = (
        df.select(F.explode(cells).alias("_c"))
        .select("_c.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    short = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("_d")).filter(F.col("_d") <= up_to)
    return counts.join(F.broadcast(short.select("column_name")), "column_name")  # at most one row per column


def conjunction(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
