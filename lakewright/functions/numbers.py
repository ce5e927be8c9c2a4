"""Numbers: dirty text, rounding, ratios and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of each reaction in the engagement score.
SHARE_WEIGHT = 4
COMMENT_WEIGHT = 3
LIKE_WEIGHT = 2
IMPRESSION_WEIGHT = 1


def to_number(text: Column) -> Column:
    """Text -> double; text that is not a number -> NULL."""
    return text.try_cast("double")


def money(text: Column, thousands: bool = False) -> Column:
    """``$120.00`` -> decimal(10,2); with ``thousands`` commas are dropped as well."""
    return F.regexp_replace(text, "[$,]" if thousands else "[$]", "").try_cast("decimal(10,2)")


def scaled(value: Column, factor: int = 1000) -> Column:
    return F.round(value * F.lit(factor), 0)


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal the number prints as."""
    number = value.cast("double")
    # ten places first, so that 0.15 as a sum of parts rounds as 0.15 does
    return F.round(F.round(number, max(digits, 10)), digits)


def percent_change(new: Column, old: Column) -> Column:
    """100 * (new - old) / old; NULL on a zero base."""
    return F.try_divide((new - old) * F.lit(100.0), old)


def engagement_score(likes: Column, shares: Column, comments: Column, impressions: Column) -> Column:
    """Weighted reactions per impression, four places, 0 without impressions."""
    weighted = (
        shares * F.lit(SHARE_WEIGHT)
        + comments * F.lit(COMMENT_WEIGHT)
        + likes * F.lit(LIKE_WEIGHT)
        + impressions * F.lit(IMPRESSION_WEIGHT)
    )
    ratio = F.try_divide(weighted.cast("decimal(20,0)"), impressions.cast("decimal(20,0)"))
    return F.when(impressions == 0, F.lit(0)).otherwise(F.round(ratio, 4)).cast("decimal(20,4)")


def virality(shares: Column, impressions: Column) -> Column:
    """Shares per impression, four places, NULL without impressions."""
    ratio = F.try_divide(shares.cast("decimal(20,0)"), impressions.cast("decimal(20,0)"))
    return F.round(ratio, 4).cast("decimal(20,4)")
