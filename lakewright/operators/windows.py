"""Window operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.functions.dates import month_index
from lakewright.functions.numbers import percent_change, rounded


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], tie_breakers: Sequence[str]) -> DataFrame:
    """The newest row of each key; ties are settled by ``tie_breakers``, largest first.

    ``row_number() = 1`` is cut to one row per key before the shuffle as well as
    after it, so a key with very many copies sends one row per map task.
    """
    newest = [order_by] if isinstance(order_by, str) else list(order_by)
    if not tie_breakers:
        raise ValueError("tie_breakers must make the order total")
    order = [F.col(c).desc_nulls_last() for c in [*newest, *tie_breakers]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def trend_metrics(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    lags: Mapping[str, int],
    rolling: int = 3,
    mode: str = "rows",
    change_digits: int | None = 1,
    percent_digits: int | None = 2,
    rolling_digits: int | None = 1,
) -> DataFrame:
    """Change and percent change per named lag, and the mean of the last ``rolling`` periods.

    The frame has one row per key and month, so a series is as long as the
    calendar. ``rows`` counts rows back; ``calendar`` counts months back, so a
    missing month gives NULL and never a wrong neighbour. All metrics share one
    shuffle and one sort.
    """
    series = Window.partitionBy(*keys)
    if mode == "rows":
        ordered = series.orderBy(time)
        recent = ordered.rowsBetween(1 - rolling, Window.currentRow)

        def back(n: int) -> Column:
            return F.lag(value, n).over(ordered)

    elif mode == "calendar":
        ordered = series.orderBy(month_index(F.col(time)))
        recent = ordered.rangeBetween(1 - rolling, Window.currentRow)

        def back(n: int) -> Column:
            return F.max(value).over(ordered.rangeBetween(-n, -n))

    else:
        raise ValueError(f"unknown mode '{mode}'")

    def cut(column: Column, digits: int | None) -> Column:
        return column if digits is None else rounded(column, digits)

    metrics: dict[str, Column] = {}
    for name, n in lags.items():
        metrics[f"{name}_change"] = cut(F.col(value) - back(n), change_digits)
        metrics[f"{name}_change_pct"] = cut(percent_change(F.col(value), back(n)), percent_digits)
    # at most ``rolling`` values in a fixed order, added in the column's own type
    mean = F.avg(value).over(recent).cast("double")
    metrics[f"rolling_{rolling}_avg"] = cut(mean, rolling_digits)
    return df.withColumns(metrics)
