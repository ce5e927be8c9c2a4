"""Projections, renames and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.functions.text import decoded, parsed
from lakewright.operators.joins import enrich
from lakewright.operators.projections import (
    add_load_audit,
    add_period_columns,
    drop_present,
    flatten_struct,
    rename_contract,
    sample_of,
    sanitize_names,
)
from lakewright.plans.engagement import EVENT_SCHEMA, event_view
from lakewright.plans.labour import PROVINCE_NAMES
from lakewright.plans.rentals import HOST_NAMES, LISTING_NAMES, REVIEW_NAMES
from lakewright.streaming.ingest import parse_messages


@query("prj_01_drop_present", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    unwanted = ["l_partkey", "l_suppkey", "l_discount", "l_tax", "l_linestatus", "l_shipdate", "l_comment"]
    return drop_present(table(spark, sf, "lineitem"), unwanted)


@query(
    "prj_02_sanitize_names",
    """SELECT p_partkey AS Part_Key, p_name AS Part_name_short, p_retailprice AS North_American_price_USD FROM part""",
)
def sanitized(spark: SparkSession, sf: str) -> DataFrame:
    return sanitize_names(
        table(spark, sf, "part").select(
            F.col("p_partkey").alias("Part Key"),
            F.col("p_name").alias("__Part  name (short)"),
            F.col("p_retailprice").alias("North American price (USD)"),
        )
    )


@query(
    "prj_03_contract_rename",
    f"""WITH {s.PROVINCE_ARRIVAL}
        SELECT ref_date_raw, geo, labour_force_characteristic, amount::varchar AS value_raw, status FROM province_arrival""",
)
def contract_rename(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ("REF_DATE", "GEO", "Labour_force_characteristics", "VALUE", "STATUS")
    mapping = {old: new for old, new in PROVINCE_NAMES.items() if old in wanted}
    return rename_contract(sanitize_names(s.province_arrival(spark, sf)), mapping)


@query(
    "prj_04_load_audit",
    """SELECT o_orderkey, TIMESTAMP '2002-01-01 10:00:00' AS _ingested_at, 'orders.csv' AS _source_file FROM orders""",
)
def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    at = s.FIRST_LOAD.replace(microsecond=654_321)
    return add_load_audit(table(spark, sf, "orders").select("o_orderkey"), "orders.csv", at)


@query(
    "prj_05_period_columns",
    """SELECT l_orderkey, l_linenumber, l_shipdate, strftime(l_shipdate, '%Y') AS ship_year, strftime(l_shipdate, '%m') AS ship_month
       FROM lineitem""",
)
def period_columns(spark: SparkSession, sf: str) -> DataFrame:
    return add_period_columns(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), "l_shipdate", "ship")


@query(
    "prj_06_source_aliases",
    f"""WITH {s.LISTINGS},{s.HOSTS}
        SELECT 'listing' AS source, id, name, price AS detail FROM raw_listings
        UNION ALL SELECT 'host', id, name, is_superhost FROM raw_hosts""",
)
def source_aliases(spark: SparkSession, sf: str) -> DataFrame:
    listings = rename_contract(s.raw_listings(spark, sf), LISTING_NAMES)
    hosts = rename_contract(s.raw_hosts(spark, sf), HOST_NAMES)
    return listings.select(
        F.lit("listing").alias("source"), F.col("listing_id").alias("id"), F.col("listing_name").alias("name"), F.col("price_str").alias("detail")
    ).unionByName(
        hosts.select(
            F.lit("host").alias("source"), F.col("host_id").alias("id"), F.col("host_name").alias("name"), F.col("is_superhost").alias("detail")
        )
    )


@query(
    "prj_06_review_aliases",
    """SELECT l_partkey AS listing_id, l_shipdate AS review_date, 'reviewer ' || l_suppkey AS reviewer_name,
              CASE WHEN l_discount > 0 THEN 'stay ' || l_orderkey END AS review_text,
              CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END AS review_sentiment
       FROM lineitem""",
)
def review_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return rename_contract(s.raw_reviews(spark, sf), REVIEW_NAMES)


@query(
    "prj_07_struct_flatten",
    f"""WITH {s.ENGAGEMENT}
        SELECT event_id, event_type, user_id, content_id, device_type, watch_duration, event_id::bigint AS _kafka_offset FROM engagement""",
)
def struct_flatten(spark: SparkSession, sf: str) -> DataFrame:
    messages = s.engagement_messages(spark, sf)
    events = messages.select(parsed(decoded(F.col("value")), EVENT_SCHEMA).alias("event"), "offset")
    return flatten_struct(events, "event", {"offset": "_kafka_offset"}).select(
        "event_id", "event_type", "user_id", "content_id", "device_type", "watch_duration", "_kafka_offset"
    )


@query(
    "prj_08_star_after_join",
    """SELECT n_name, c.* FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def star_after_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = enrich(table(spark, sf, "customer"), table(spark, sf, "nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"})
    return joined.select("n_name", *[c for c in joined.columns if c != "n_name"])


@query("prj_09_conditional_sample", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey, p_name LIMIT 5")
def conditional_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sample_of(table(spark, sf, "part"), ["p_partkey", "p_missing", "p_name"], 5)


@query(
    "prj_10_cast_view",
    f"""WITH {s.ENGAGEMENT}
        SELECT event_id, event_type, event_ts, ingestion_ts FROM engagement
        WHERE NOT (content_type = 'gif')""",
)
def cast_view(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose time does not read are left out; here those of one content kind."""
    events = parse_messages(s.engagement_messages(spark, sf), EVENT_SCHEMA)
    broken = events.withColumn("event_ts", F.when(F.col("content_type") == "gif", "soon").otherwise(F.col("event_ts")))
    return event_view(broken).select("event_id", "event_type", "event_ts", "ingestion_ts")
