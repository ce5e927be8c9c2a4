"""Dates, timestamps and time windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def moment(value: date | datetime, kind: str | DataType = "timestamp") -> Column:
    """A wall-clock time as a literal of the given date or timestamp type, read in the session's zone."""
    return F.lit(str(value)).cast(kind)


def month_start_from_text(text: Column) -> Column:
    """``1976-01`` -> 1976-01-01; unreadable text -> NULL."""
    return F.try_to_date(F.concat_ws("-", text, F.lit("01")), "yyyy-MM-dd")


def year_month_text(value: Column) -> Column:
    """Anything that reads as a timestamp -> ``yyyy-MM``."""
    return F.date_format(value.try_cast("timestamp"), "yyyy-MM")


def iso_timestamp(text: Column, fmt: str | None = None) -> Column:
    """ISO-8601 text (or text in ``fmt``) -> timestamp; unreadable text -> NULL."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def year_part(day: Column) -> Column:
    return F.date_format(day, "yyyy")


def month_part(day: Column) -> Column:
    return F.date_format(day, "MM")


def month_index(day: Column) -> Column:
    """Consecutive number of the calendar month, so that one year is 12 apart."""
    return F.year(day) * F.lit(12) + F.month(day)


def tumbling(ts: Column, width: str = "5 minutes") -> Column:
    """Struct (start, end) of the fixed window that holds ``ts``."""
    return F.window(ts, width)


def floor_to_minutes(ts: Column, minutes: int = 5) -> Column:
    """Start of the window by minute arithmetic; equals ``tumbling(...).start`` within an hour."""
    return F.date_trunc("minute", ts) - F.make_dt_interval(
        mins=F.minute(ts) % F.lit(minutes)
    )


def later_of(first: Column, second: Column) -> Column:
    """Greatest of two values, NULL when either is NULL."""
    return F.when(first.isNotNull() & second.isNotNull(), F.greatest(first, second))
