"""Ranks over a whole frame, without sorting it in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.operators.skew import salted_join
from lakewright.session import stored

#: Distinct values that one task sorts: ranges are made so that each holds about as many.
RANGE_VALUES = 1_000_000


def value_ranges(counts: DataFrame, order: Column, range_values: int = RANGE_VALUES) -> DataFrame:
    """``counts`` (stored) with ``_range`` and ``_part``, which follow ``order`` and hold some ``range_values`` rows each.

    The number of ranges comes from the number of rows, their bounds from Spark's own
    sample. A range that turns out more than twice as long is dealt into parts of its own.
    """
    n = counts.count()
    if n <= range_values:
        return counts.withColumns({"_range": F.lit(0), "_part": F.lit(0)})
    # stored, as a range is told by where its rows came to lie
    dealt = counts.repartitionByRange(math.ceil(n / range_values), order).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "value-ranges")
    large = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 2 * range_values)
    in_large = large.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()["n"]
    if not in_large:
        return dealt.withColumn("_part", F.lit(0))
    again = dealt.join(large.select("_range"), "_range").repartitionByRange(math.ceil(in_large / range_values), "_range", order)
    again = stored(again.withColumn("_part", F.spark_partition_id()), "value-parts")
    return dealt.join(large.select("_range"), "_range", "left_anti").withColumn("_part", F.lit(0)).unionByName(again)


def _ranged_counts(df: DataFrame, by: str, descending: bool, range_values: int) -> DataFrame:
    """Distinct values with their count ``n``, range, and the range's size and number of rows ahead of it.

    Values are counted first, so copies collapse before the shuffle; there is one sum per range.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    counts = stored(df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    ranged = value_ranges(counts, order, range_values)
    before = Window.orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        ranged.groupBy("_range", "_part")
        .agg(F.sum("n").alias("_size"))
        .withColumn("_ahead", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    )
    return ranged.join(ranges, ["_range", "_part"])


def _positioned(ranged: DataFrame, by: str, descending: bool) -> DataFrame:
    """Rows ahead of each value: those of the ranges ahead and those inside its own."""
    inside = (
        Window.partitionBy("_range", "_part")
        .orderBy(F.col(by).desc() if descending else F.col(by).asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.select(by, "n", (F.col("_ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("ahead"))


def value_positions(df: DataFrame, by: str, descending: bool = False, range_values: int = RANGE_VALUES) -> DataFrame:
    """One row per distinct value: its count ``n`` and the number of rows ``ahead`` of it.

    Values of any type that can be ordered; NaN is the greatest number. No task sorts
    more than one range of the distinct values. Starts the jobs that store and size them.
    """
    return _positioned(_ranged_counts(df, by, descending, range_values), by, descending)


def average_rank(df: DataFrame, by: str, rank: str = "avg_rank", descending: bool = True) -> DataFrame:
    """Add the rank of each row; ties share the mean of their positions, NULL has no rank."""
    ranks = value_positions(df, by, descending).select(by, (F.col("ahead") + (F.col("n") + 1) / 2).alias(rank))
    return salted_join(df, ranks, [by], "left").select(*[F.col(f"l.{c}") for c in df.columns], F.col(f"r.{rank}"))


def exact_quantile(df: DataFrame, by: str, share: float, name: str = "quantile", range_values: int = RANGE_VALUES) -> DataFrame:
    """One row with the interpolated quantile. Only the range that holds it is sorted."""
    ranged = _ranged_counts(df, by, False, range_values)
    total = ranged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    at = (total - 1) * F.lit(share)
    low, high = F.floor(at), F.ceil(at)
    near = ranged.filter((F.col("_ahead") <= high) & (low < F.col("_ahead") + F.col("_size")))
    positions = _positioned(near, by, False)

    def value_at(position: Column) -> Column:
        holds = (F.col("ahead") <= position) & (position < F.col("ahead") + F.col("n"))
        return F.max(F.when(holds, F.col(by)))

    between = value_at(high) - value_at(low)
    # two equal infinities have no difference
    step = F.when(value_at(high) == value_at(low), F.lit(0.0)).otherwise(between.cast("double") * F.max(at - low))
    return positions.agg((value_at(low) + step).alias(name))
