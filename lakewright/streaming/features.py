"""Windowed engagement features, for batch and stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions.numbers import engagement_score, virality


@dataclass(frozen=True)
class EventNames:
    """Which event types play the four reactions."""

    like: str = "like"
    share: str = "share"
    comment: str = "comment"
    impression: str = "impression"


def _windowed(events: DataFrame, key: str, at: str, width: str, watermark: str | None):
    source = events.withWatermark(at, watermark) if watermark else events
    return source.groupBy(F.window(at, width), key)


def user_features(
    events: DataFrame,
    at: str = "event_ts",
    user: str = "user_id",
    width: str = "5 minutes",
    watermark: str | None = None,
    names: EventNames = EventNames(),
) -> DataFrame:
    """Reaction counts, score and virality per user and fixed window.

    Counts combine before the shuffle, so a very busy user sends one row per
    window and map task.
    """
    kind = F.col("event_type")
    counts = _windowed(events, user, at, width, watermark).agg(
        F.count_if(kind == names.like).alias("total_likes"),
        F.count_if(kind == names.share).alias("total_shares"),
        F.count_if(kind == names.comment).alias("total_comments"),
        F.count_if(kind == names.impression).alias("total_impressions"),
    )
    likes, shares, comments, shown = (
        F.col(c) for c in ("total_likes", "total_shares", "total_comments", "total_impressions")
    )
    return counts.select(
        user,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_likes",
        "total_shares",
        "total_comments",
        "total_impressions",
        engagement_score(likes, shares, comments, shown).alias("engagement_score"),
        virality(shares, shown).alias("content_virality"),
    )


def content_features(
    events: DataFrame,
    at: str = "event_ts",
    content: str = "content_id",
    width_minutes: int = 5,
    watermark: str | None = None,
    names: EventNames = EventNames(),
    trending_from: float = 1.0,
) -> DataFrame:
    """Reactions, shares per minute, trending score and flag per content and window.

    The score is the engagement weights per minute of the window; content is
    trending from ``trending_from`` on. Both are choices of this library.
    """
    kind = F.col("event_type")
    counts = _windowed(events, content, at, f"{width_minutes} minutes", watermark).agg(
        F.count_if(kind.isin(names.like, names.share, names.comment)).alias("reaction_count"),
        F.count_if(kind == names.share).alias("_shares"),
        F.count_if(kind == names.comment).alias("_comments"),
        F.count_if(kind == names.like).alias("_likes"),
    )
    minutes = F.lit(width_minutes).cast("decimal(10,0)")
    velocity = F.round(F.col("_shares").cast("decimal(20,0)") / minutes, 4).cast("decimal(20,4)")
    weighted = F.col("_shares") * 4 + F.col("_comments") * 3 + F.col("_likes") * 2
    score = F.round(weighted.cast("decimal(20,0)") / minutes, 4).cast("decimal(20,4)")
    return counts.select(
        content,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "reaction_count",
        velocity.alias("share_velocity"),
        (score >= F.lit(trending_from)).alias("is_trending"),
        score.alias("trending_score"),
    )
