"""Whole builds: files or messages in, stored tables out.

Each step hands a stored table to the next, so a lost executor costs the tasks
of one step and a failed build can be started again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewright.operators.history import scd2_invariants
from lakewright.operators.quality import Check, gate, query_test, run_suite
from lakewright.plans import labour, rentals
from lakewright.plans.engagement import EVENT_SCHEMA
from lakewright.sinks.tables import (
    append_table,
    audit_rows,
    latest_version,
    overwrite_table,
    publish,
    publish_version,
    write_verified,
    write_version,
)
from lakewright.sources.files import read_raw_csv, read_table, table_exists
from lakewright.streaming.events import clean_events, start_upsert
from lakewright.streaming.features import user_features
from lakewright.streaming.ingest import LOADED_AT, parse_messages, start_append


@dataclass(frozen=True)
class LabourTables:
    """Folders of a labour build."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"


def labour_checks(max_null_rate: float) -> list[Check]:
    """The gate between the clean layer and the star schema."""
    checks = [
        Check("province", "rows_reconcile", "at_least_count", args={"other": "province_arrived"}),
        Check("province", "no_duplicates", "no_duplicates", columns=labour.PROVINCE_KEY),
        Check("industry", "no_duplicates", "no_duplicates", columns=labour.INDUSTRY_KEY),
        Check("industry", "geo_known", "relationship", "geo", args={"parent": "province", "parent_column": "geo"}),
    ]
    for table, code in (("province", "labour_force_characteristic"), ("industry", "naics_industry")):
        checks += [Check(table, f"{c}_null_rate", "null_rate", c, args={"max": max_null_rate}) for c in ("ref_date", "geo", code)]
        checks.append(Check(table, "value_range", "min_value", "value", args={"min": 0}))
        checks.append(Check(table, "fresh", "freshness", "ref_date", args={"days": 180}, severity="warn"))
    return checks


def build_labour(
    spark: SparkSession,
    province_csv: str,
    industry_csv: str,
    root: str,
    as_of: date,
    loaded_at: datetime | None = None,
    max_null_rate: float = 0.3,
) -> list[dict[str, object]]:
    """CSV files to the trend mart. Gives the gate's result rows; a FAIL stops the build.

    The point-in-time join uses back-loaded history, the stored dimension is
    updated from the newest values.
    """
    tables = LabourTables(root)
    shapes = {
        "province": (province_csv, labour.PROVINCE_DROPS, labour.PROVINCE_NAMES, labour.PROVINCE_KEY),
        "industry": (industry_csv, labour.INDUSTRY_DROPS, labour.INDUSTRY_NAMES, labour.INDUSTRY_KEY),
    }
    clean: dict[str, DataFrame] = {}
    frames: dict[str, DataFrame] = {}
    written: list[str] = []
    for name, (path, drops, names, key) in shapes.items():
        raw = labour.raw_layer(read_raw_csv(spark, path), drops, path, loaded_at)
        written.append(write_version(raw, tables.at(f"raw/{name}"), ["ingestion_year", "ingestion_month"], rebalance=False))
        stored = read_table(spark, written[-1], raw.schema)
        rows = labour.clean_layer(stored, names, key)
        written.append(write_version(rows, tables.at(f"clean/{name}"), ["ref_year", "ref_month"]))
        clean[name] = frames[name] = read_table(spark, written[-1], rows.schema)
        # the clean table has one row per key, so that is what the arrived rows are counted by
        arrived_key = [old for old, new in names.items() if new in (*key, "ref_date_raw")]
        frames[f"{name}_arrived"] = stored.select(*arrived_key).distinct()
    results = gate(run_suite(frames, labour_checks(max_null_rate), datetime(as_of.year, as_of.month, as_of.day)))
    # readers see the new layers only now that they have passed
    for path in written:
        publish(spark, path)
    finished = {"raw_and_clean": datetime.now()}

    dim_root = tables.at("gold/dim_employment")
    batch = labour.dimension_batch(clean["province"], as_of)
    previous = latest_version(spark, dim_root)
    dim = batch if previous is None else labour.update_dimension(read_table(spark, previous, batch.schema), batch, as_of)
    dim_path = write_version(dim, dim_root, ["is_current"])
    broken = scd2_invariants(read_table(spark, dim_path, batch.schema), labour.DIMENSION_KEY)
    gate(query_test(broken.filter(" OR ".join(f"{c} > 0" for c in broken.columns)), "dim_employment", "invariants"))
    publish(spark, dim_path, "dim_employment")
    finished["dim_employment"] = datetime.now()

    rows = labour.headline(clean["province"])
    overwrite_table(labour.geo_dimension(rows), tables.at("gold/dim_geo"))
    overwrite_table(labour.monthly_fact(rows, labour.headline(clean["industry"])), tables.at("gold/fact"))
    overwrite_table(labour.dimension_history(clean["province"]), tables.at("gold/history"))
    mart = labour.trend_mart(*(read_table(spark, tables.at(f"gold/{n}")) for n in ("fact", "history", "dim_geo")))
    write_verified(mart, tables.at("gold/mart"), ["ref_year"])
    counts = labour.mart_checks(read_table(spark, tables.at("gold/mart"), mart.schema))
    results += gate(query_test(counts.filter("repeated_keys > 0"), "mart", "grain"))
    finished["mart"] = datetime.now()
    append_table(audit_rows(spark, finished), tables.at("audit"))
    return results


def start_engagement(
    spark: SparkSession, messages: DataFrame, root: str, every: str | None = "30 seconds"
) -> tuple[StreamingQuery, str]:
    """Message stream to the raw event table; gives the query and the table's folder."""
    raw = parse_messages(messages, EVENT_SCHEMA).withColumn(LOADED_AT, F.current_timestamp())
    path = f"{root}/raw/events"
    return start_append(raw, path, f"{root}/checkpoints/raw", every), path


def start_clean_events(raw_stream: DataFrame, root: str, every: str | None = "30 seconds") -> tuple[StreamingQuery, str]:
    """Raw event stream to the deduplicated clean table."""
    path = f"{root}/clean/events"
    ties = ["ingestion_ts", "user_id", "content_id", "session_id"]
    clean = clean_events(raw_stream)
    return start_upsert(clean, path, f"{root}/checkpoints/clean", ["event_id"], "event_ts", ties, every=every), path


def build_features(spark: SparkSession, root: str, width: str = "5 minutes") -> str:
    """All user features of the clean table, as a new version; gives its folder."""
    features = user_features(read_table(spark, f"{root}/clean/events"), width=width)
    return publish_version(features, f"{root}/gold/user_features", "user_engagement_features")


def build_rentals(
    spark: SparkSession, raw: Mapping[str, DataFrame], moons: DataFrame, root: str, min_listings: int = 1000
) -> list[dict[str, object]]:
    """Listings, hosts and reviews to the full-moon mart; a FAIL stops the build.

    ``raw`` has the frames ``listings``, ``hosts`` and ``reviews``. The review
    fact grows by its new rows.
    """
    overwrite_table(rentals.hosts_cleansed(raw["hosts"]), f"{root}/dim_hosts")
    overwrite_table(rentals.listings_cleansed(raw["listings"]), f"{root}/dim_listings")
    hosts, listings = (read_table(spark, f"{root}/{n}") for n in ("dim_hosts", "dim_listings"))
    overwrite_table(rentals.listings_with_hosts(listings, hosts), f"{root}/dim_listings_with_hosts")
    joined = read_table(spark, f"{root}/dim_listings_with_hosts")
    checks = [
        Check("listings", "minimum_rows", "min_rows", args={"min": min_listings}, severity="warn"),
        Check("listings", "id_present", "not_null", "listing_id"),
        Check("listings", "id_unique", "unique", "listing_id"),
        Check("listings", "host_present", "not_null", "host_id"),
        Check("listings", "host_known", "relationship", "host_id", args={"parent": "hosts", "parent_column": "host_id"}),
        Check("listings", "room_type", "accepted_values", "room_type", args={"values": rentals.ROOM_TYPES}),
        Check("listings", "nights_positive", "positive", "minimum_nights"),
        Check("joined", "as_many_as_listings", "same_count", args={"other": "listings"}),
        Check("joined", "mean_price", "mean_between", "price", args={"low": 50, "high": 300}),
        Check("joined", "max_price", "max_between", "price", args={"high": 5000}, severity="warn"),
    ]
    results = gate(run_suite({"listings": listings, "hosts": hosts, "joined": joined}, checks))
    path = f"{root}/fact_reviews"
    reviews = rentals.review_fact(raw["reviews"])
    if table_exists(spark, path):
        append_table(rentals.new_reviews(read_table(spark, path), reviews), path)
    else:
        append_table(reviews, path)
    overwrite_table(rentals.full_moon_reviews(read_table(spark, path), moons), f"{root}/mart_full_moon")
    return results
