"""Classification of codes and names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that mark a value as suppressed.
SUPPRESSION_CODES = ("..", "x")

# The whole-country name and the regions of its provinces.
NATIONAL = "Canada"
REGIONS = {
    "Western Canada": ("British Columbia", "Alberta", "Saskatchewan", "Manitoba"),
    "Central Canada": ("Ontario", "Quebec"),
    "Atlantic Canada": ("New Brunswick", "Nova Scotia", "Prince Edward Island", "Newfoundland and Labrador"),
    "National": ("Canada",),
}

# Devices and content kinds behind the two event flags.
MOBILE_DEVICES = ("mobile_ios", "mobile_android")
VIRAL_CONTENT = ("reel", "video")


def in_codes(code: Column, codes: Sequence[str]) -> Column:
    """True when the code is listed; NULL counts as not listed."""
    return F.coalesce(code.isin(*codes), F.lit(False))


def unless(flag: Column, value: Column) -> Column:
    """The value, or NULL where the flag is set."""
    return F.when(~flag, value)


def grouped_label(value: Column, groups: Mapping[str, Sequence[str]], other: str) -> Column:
    """Label of the first group that lists the value."""
    label = None
    for name, members in groups.items():
        listed = value.isin(*members)
        label = F.when(listed, F.lit(name)) if label is None else label.when(listed, F.lit(name))
    return F.lit(other) if label is None else label.otherwise(F.lit(other))


def geo_level(geo: Column) -> Column:
    return F.when(geo == NATIONAL, F.lit("National")).otherwise(F.lit("Province"))


def geo_region(geo: Column) -> Column:
    return grouped_label(geo, REGIONS, "Other")


def at_least_one(nights: Column) -> Column:
    """Zero nights means one."""
    return F.when(nights == 0, F.lit(1)).otherwise(nights)
