"""Small reference tables computed from a date span."""

from __future__ import annotations

from calendar import monthrange
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

# One full moon and the mean length of a lunation in minutes.
FIRST_FULL_MOON = datetime(1995, 1, 16, 20, 26)
LUNATION_MINUTES = 42_524


def full_moons(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Mean full-moon dates between two days, about 12.4 rows per year of the span."""
    step = timedelta(minutes=LUNATION_MINUTES)
    start = datetime.combine(first, datetime.min.time())
    moon = FIRST_FULL_MOON + step * -((FIRST_FULL_MOON - start) // step)
    days = []
    while moon.date() <= last:
        if moon.date() >= first:
            days.append((moon.date(),))
        moon += step
    return spark.createDataFrame(days, StructType([StructField("full_moon_date", DateType(), False)]))


def yearly_holidays(spark: SparkSession, first: date, last: date, month_days: list[tuple[int, int]]) -> DataFrame:
    """The given (month, day) holidays of every year in the span that has the day."""
    days = [
        (date(year, month, day),)
        for year in range(first.year, last.year + 1)
        for month, day in month_days
        if day <= monthrange(year, month)[1] and first <= date(year, month, day) <= last
    ]
    return spark.createDataFrame(days, StructType([StructField("holiday_date", DateType(), False)]))
