"""Rental listings, hosts and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions.classify import at_least_one
from lakewright.functions.dates import later_of
from lakewright.functions.numbers import money
from lakewright.operators.aggregates import group_counts
from lakewright.operators.incremental import append_new, new_since
from lakewright.operators.joins import flag_dates
from lakewright.operators.projections import rename_contract
from lakewright.operators.skew import small

# Source column -> model column.
LISTING_NAMES = {
    "id": "listing_id",
    "listing_url": "listing_url",
    "name": "listing_name",
    "room_type": "room_type",
    "minimum_nights": "minimum_nights",
    "host_id": "host_id",
    "price": "price_str",
    "created_at": "created_at",
    "updated_at": "updated_at",
}
HOST_NAMES = {
    "id": "host_id",
    "name": "host_name",
    "is_superhost": "is_superhost",
    "created_at": "created_at",
    "updated_at": "updated_at",
}
REVIEW_NAMES = {
    "listing_id": "listing_id",
    "date": "review_date",
    "reviewer_name": "reviewer_name",
    "comments": "review_text",
    "sentiment": "review_sentiment",
}
# Accepted room types.
ROOM_TYPES = ("Entire home/apt", "Private room", "Shared room", "Hotel room")

FULL_MOON, NOT_FULL_MOON = "full moon", "not full moon"
LONG_STAY_NIGHTS = 30


def hosts_cleansed(raw: DataFrame, missing_name: str = "Anonymous") -> DataFrame:
    return rename_contract(raw, HOST_NAMES).withColumn("host_name", F.coalesce("host_name", F.lit(missing_name)))


def listings_cleansed(raw: DataFrame, thousands: bool = False) -> DataFrame:
    renamed = rename_contract(raw, LISTING_NAMES)
    return renamed.select(
        "listing_id",
        "listing_name",
        "room_type",
        at_least_one(F.col("minimum_nights")).alias("minimum_nights"),
        "host_id",
        money(F.col("price_str"), thousands).alias("price"),
        "created_at",
        "updated_at",
    )


def listings_with_hosts(listings: DataFrame, hosts: DataFrame) -> DataFrame:
    """Every listing with its host; the update time is the later of both and unknown without a host."""
    l, h = listings.alias("l"), small(hosts.select("host_id", "host_name", "is_superhost", "updated_at")).alias("h")
    return l.join(h, F.col("l.host_id") == F.col("h.host_id"), "left").select(
        "l.listing_id",
        "l.listing_name",
        "l.room_type",
        "l.minimum_nights",
        "l.price",
        "l.host_id",
        "h.host_name",
        F.col("h.is_superhost").alias("host_is_superhost"),
        "l.created_at",
        later_of(F.col("l.updated_at"), F.col("h.updated_at")).alias("updated_at"),
    )


def review_fact(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Reviews with a text; with a target, only those after its newest are added."""
    reviews = rename_contract(raw, REVIEW_NAMES).filter(F.col("review_text").isNotNull())
    return reviews if target is None else append_new(target, reviews, "review_date")


def new_reviews(target: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews after the newest one stored."""
    return new_since(target, reviews, "review_date")


def full_moon_reviews(reviews: DataFrame, moons: DataFrame) -> DataFrame:
    """Reviews marked when they were written the day after a full moon."""
    return flag_dates(
        reviews, "review_date", moons, "full_moon_date", "is_full_moon", FULL_MOON, NOT_FULL_MOON, shift_days=1
    )


def sentiment_by_moon(mart: DataFrame) -> DataFrame:
    return group_counts(mart, ["is_full_moon", "review_sentiment"], "reviews").orderBy("is_full_moon", "review_sentiment")


def long_stays(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("minimum_nights") >= LONG_STAY_NIGHTS).select("listing_id", "listing_name", "price")
