"""Incremental loads: high-water mark, look-back merge, time batches and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.dates import moment
from lakewright.operators.windows import keep_latest
from lakewright.sinks.tables import SchemaMismatch, same_columns


def new_since(target: DataFrame, source: DataFrame, at: str, inclusive: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Source rows after the target's latest time; all of them for an empty target.

    ``inclusive`` also takes rows sharing the latest time unless their ``keys``
    are in the target. A different schema is refused.
    """
    if not same_columns(target.schema, source.schema):
        raise SchemaMismatch(f"target {target.schema.simpleString()}, source {source.schema.simpleString()}")
    mark = target.agg(F.max(at).alias("mark")).scalar()
    if not inclusive:
        return source.filter(mark.isNull() | (F.col(at) > mark))
    if not keys:
        raise ValueError("an inclusive mark needs the keys that tell rows apart")
    recent = source.filter(mark.isNull() | (F.col(at) >= mark))
    return recent.join(target.filter(F.col(at) == mark).select(*keys).distinct(), list(keys), "left_anti")


def append_new(target: DataFrame, source: DataFrame, at: str, inclusive: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Target with the source's new rows."""
    return target.unionByName(new_since(target, source, at, inclusive, keys))


def lookback_start(as_of: datetime, lookback: timedelta, align: timedelta) -> datetime:
    """Start of the slice to recompute, moved back to a window edge so that no window is cut."""
    cut = as_of - lookback
    return cut - (cut - datetime(1970, 1, 1)) % align


def merge_by_key(target: DataFrame, fresh: DataFrame, keys: Sequence[str], touched: Column | None = None) -> DataFrame:
    """Target with rows replaced or added by key; columns only one side has are NULL on the other.

    ``touched`` is a condition every fresh row meets: target rows that do not
    meet it pass by the join.
    """
    open_rows = target if touched is None else target.filter(touched)
    kept = open_rows.join(fresh.select(*keys), list(keys), "left_anti")
    if touched is not None:
        kept = target.filter(~F.coalesce(touched, F.lit(False))).unionByName(kept)
    return kept.unionByName(fresh, allowMissingColumns=True)


def batch_ranges(begin: date, end: date, size: str = "year") -> list[tuple[date, date]]:
    """Half-open calendar ranges (year, month or day) from ``begin`` to past ``end``."""
    ranges, start = [], begin
    while start <= end:
        if size == "year":
            stop = date(start.year + 1, 1, 1)
        elif size == "month":
            stop = date(start.year + start.month // 12, start.month % 12 + 1, 1)
        elif size == "day":
            stop = start + timedelta(days=1)
        else:
            raise ValueError(f"unknown batch size '{size}'")
        ranges.append((start, stop))
        start = stop
    return ranges


def in_range(df: DataFrame, at: str, start: date, stop: date) -> DataFrame:
    kind = df.schema[at].dataType
    return df.filter((F.col(at) >= moment(start, kind)) & (F.col(at) < moment(stop, kind)))


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], tie_breakers: Sequence[str]
) -> DataFrame:
    """Existing rows plus one row per key they lack; existing rows win."""
    return existing.unionByName(rows_to_insert(existing, incoming, keys, order_by, tie_breakers))


def rows_to_insert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], tie_breakers: Sequence[str]
) -> DataFrame:
    """The incoming rows an insert-if-absent would add, copies inside the batch removed first."""
    unique = keep_latest(incoming, keys, order_by, tie_breakers)
    return unique.join(existing.select(*keys), list(keys), "left_anti")
