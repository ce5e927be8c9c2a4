"""Survey, engagement and rental inputs derived from the driver's tables, with their SQL twins.

Every frame is computed from whole tables. A twin is a list of common table
expressions to put after ``WITH``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog.base import table
from lakewright.functions.dates import moment
from lakewright.operators.skew import small
from lakewright.plans.engagement import EVENT_SCHEMA
from lakewright.session import scratch_path
from lakewright.sinks.tables import append_table
from lakewright.plans.labour import (
    ALL_INDUSTRIES,
    INDUSTRY_DROPS,
    INDUSTRY_KEY,
    INDUSTRY_NAMES,
    PROVINCE_DROPS,
    PROVINCE_KEY,
    PROVINCE_NAMES,
    clean_layer,
    raw_layer,
)

FIRST_LOAD = datetime(2002, 1, 1, 10, 0, 0)
SECOND_LOAD = datetime(2002, 1, 1, 11, 0, 0)
REVISED_FROM = "2000-01"

# Geographies of the survey, in order.
GEOGRAPHIES = (
    "Canada",
    "Newfoundland and Labrador",
    "Prince Edward Island",
    "Nova Scotia",
    "New Brunswick",
    "Quebec",
    "Ontario",
    "Manitoba",
    "Saskatchewan",
    "Alberta",
    "British Columbia",
)


def geography(key: Column, otherwise: Column) -> Column:
    """The first nations stand for the survey's geographies, the others for themselves."""
    names = F.array(*[F.lit(g) for g in GEOGRAPHIES])
    return F.when(key < len(GEOGRAPHIES), F.try_element_at(names, (key + 1).cast("int"))).otherwise(otherwise)


GEO_CASES = " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(GEOGRAPHIES))


def priced_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their month, customer attributes and geography."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = small(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .withColumn("ref", F.date_format("o_orderdate", "yyyy-MM"))
        .withColumn("geo", geography(F.col("n_nationkey"), F.col("n_name")))
        .withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    )


PRICED = f"""
priced AS (
  SELECT o.*, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_nationkey, n.n_name,
         strftime(o_orderdate, '%Y-%m') AS ref, o_totalprice::decimal(18,2) AS price,
         CASE n_nationkey {GEO_CASES} ELSE n_name END AS geo
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey
)"""


def _status(total: Column) -> Column:
    return F.when(total < 50_000, "x").when(total > 900_000, "..")


def province_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The province file: one row per month, geography, characteristic, gender, age group and statistic."""
    cells = (
        priced_orders(spark, sf)
        .withColumn(
            "gender",
            F.when(F.col("o_orderstatus") == "O", "Total - Gender").when(F.col("o_orderstatus") == "F", "Women+").otherwise("Men+"),
        )
        .withColumn("age", F.when(F.col("c_acctbal") < 0, "15 to 24 years").otherwise("15 years and over"))
        .withColumn("stat", F.when(F.col("c_mktsegment") == "FURNITURE", "Standard error").otherwise("Estimate"))
        .groupBy("ref", "geo", "n_nationkey", "o_orderpriority", "gender", "age", "stat")
        .agg(F.sum("price").alias("total"))
    )
    none = F.lit(None).cast("string")
    code = F.col("n_nationkey").cast("string")
    return cells.select(
        F.col("ref").alias("REF_DATE"),
        F.col("geo").alias("GEO"),
        F.concat(F.lit("2021A000"), code).alias("DGUID"),
        F.col("o_orderpriority").alias("Labour force characteristics"),
        F.col("gender").alias("Gender"),
        F.col("age").alias("Age group"),
        F.col("stat").alias("Statistics"),
        F.lit("Seasonally adjusted").alias("Data type"),
        F.lit("Persons in thousands").alias("UOM"),
        F.lit("428").alias("UOM_ID"),
        F.lit("thousands").alias("SCALAR_FACTOR"),
        F.lit("3").alias("SCALAR_ID"),
        F.concat(F.lit("v"), code).alias("VECTOR"),
        F.concat_ws(".", code, F.substring("o_orderpriority", 1, 1), F.col("gender")).alias("COORDINATE"),
        F.col("total").cast("decimal(18,1)").cast("string").alias("VALUE"),
        _status(F.col("total")).alias("STATUS"),
        none.alias("SYMBOL"),
        none.alias("TERMINATED"),
        F.lit("1").alias("DECIMALS"),
    )


def industry_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The industry file: one row per month, geography and industry, and one for all industries."""
    cells = (
        priced_orders(spark, sf)
        .select("ref", "geo", "n_nationkey", "price", F.explode(F.array("c_mktsegment", F.lit(ALL_INDUSTRIES))).alias("naics"))
        .groupBy("ref", "geo", "n_nationkey", "naics")
        .agg(F.sum("price").alias("total"))
    )
    none = F.lit(None).cast("string")
    code = F.col("n_nationkey").cast("string")
    return cells.select(
        F.col("ref").alias("REF_DATE"),
        F.col("geo").alias("GEO"),
        F.concat(F.lit("2021A000"), code).alias("DGUID"),
        F.col("naics").alias("North American Industry Classification System (NAICS)"),
        F.lit("Estimate").alias("Statistics"),
        F.lit("Seasonally adjusted").alias("Data type"),
        F.lit("Persons in thousands").alias("UOM"),
        F.lit("428").alias("UOM_ID"),
        F.lit("thousands").alias("SCALAR_FACTOR"),
        F.lit("3").alias("SCALAR_ID"),
        F.concat(F.lit("v"), code).alias("VECTOR"),
        F.concat_ws(".", code, F.col("naics")).alias("COORDINATE"),
        F.col("total").cast("decimal(18,1)").cast("string").alias("VALUE"),
        none.alias("STATUS"),
        none.alias("SYMBOL"),
        none.alias("TERMINATED"),
        F.lit("1").alias("DECIMALS"),
    )


def two_loads(arrived: DataFrame, drops: tuple[str, ...], source: str) -> DataFrame:
    """The file as first loaded, and its later months loaded again with revised values."""
    loads = F.when(F.col("REF_DATE") >= REVISED_FROM, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    revised = (F.col("VALUE").cast("decimal(18,1)") + F.lit(0.5).cast("decimal(2,1)")).cast("decimal(18,1)").cast("string")
    delivered = arrived.withColumn("revision", F.explode(loads)).withColumn(
        "VALUE", F.when(F.col("revision"), revised).otherwise(F.col("VALUE"))
    )
    loaded_at = F.when(F.col("revision"), moment(SECOND_LOAD)).otherwise(moment(FIRST_LOAD))
    return raw_layer(delivered, drops, source, loaded_at).drop("revision")


def province_raw(spark: SparkSession, sf: str) -> DataFrame:
    return two_loads(province_arrival(spark, sf), PROVINCE_DROPS, "province.csv")


def industry_raw(spark: SparkSession, sf: str) -> DataFrame:
    return two_loads(industry_arrival(spark, sf), INDUSTRY_DROPS, "industry.csv")


def province_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_layer(province_raw(spark, sf), PROVINCE_NAMES, PROVINCE_KEY)


def industry_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_layer(industry_raw(spark, sf), INDUSTRY_NAMES, INDUSTRY_KEY)


PROVINCE_ARRIVAL = f"""{PRICED},
province_cells AS (
  SELECT ref, geo, n_nationkey, o_orderpriority,
         CASE o_orderstatus WHEN 'O' THEN 'Total - Gender' WHEN 'F' THEN 'Women+' ELSE 'Men+' END AS gender,
         CASE WHEN c_acctbal < 0 THEN '15 to 24 years' ELSE '15 years and over' END AS age,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Standard error' ELSE 'Estimate' END AS stat,
         sum(price) AS total
  FROM priced GROUP BY ALL
),
province_arrival AS (
  SELECT ref AS ref_date_raw, geo, '2021A000' || n_nationkey AS dguid,
         o_orderpriority AS labour_force_characteristic, gender, age AS age_group, stat AS statistic_type,
         'Seasonally adjusted' AS data_type, 'Persons in thousands' AS unit_of_measure,
         'thousands' AS scalar_factor, 'v' || n_nationkey AS vector_id,
         concat_ws('.', n_nationkey::varchar, substr(o_orderpriority, 1, 1), gender) AS coordinate,
         total::decimal(18,1) AS amount,
         CASE WHEN total < 50000 THEN 'x' WHEN total > 900000 THEN '..' END AS status, '1' AS decimals
  FROM province_cells
)"""

PROVINCE_CLEAN = f"""{PROVINCE_ARRIVAL},
province_loads AS (
  SELECT *, TIMESTAMP '2002-01-01 10:00:00' AS _ingested_at FROM province_arrival
  UNION ALL
  SELECT * REPLACE ((amount + 0.5::decimal(2,1))::decimal(18,1) AS amount), TIMESTAMP '2002-01-01 11:00:00'
  FROM province_arrival WHERE ref_date_raw >= '{REVISED_FROM}'
),
province AS (
  SELECT * EXCLUDE (amount, ref_date_raw), 'province.csv' AS _source_file,
         (ref_date_raw || '-01')::date AS ref_date,
         coalesce(status IN ('..', 'x'), false) AS is_suppressed,
         CASE WHEN NOT coalesce(status IN ('..', 'x'), false) THEN amount::varchar::double END AS value,
         left(ref_date_raw, 4) AS ref_year, right(ref_date_raw, 2) AS ref_month
  FROM province_loads
  QUALIFY row_number() OVER (PARTITION BY ref_date_raw, geo, labour_force_characteristic, gender, age_group, statistic_type, data_type
                             ORDER BY _ingested_at DESC) = 1
)"""

INDUSTRY_CLEAN = f"""
industry_cells AS (
  SELECT ref, geo, n_nationkey, naics, sum(price) AS total
  FROM (SELECT ref, geo, n_nationkey, price, c_mktsegment AS naics FROM priced
        UNION ALL SELECT ref, geo, n_nationkey, price, '{ALL_INDUSTRIES}' FROM priced)
  GROUP BY ALL
),
industry AS (
  SELECT (ref || '-01')::date AS ref_date, geo, naics AS naics_industry, 'Estimate' AS statistic_type,
         'Seasonally adjusted' AS data_type, false AS is_suppressed,
         (CASE WHEN ref >= '{REVISED_FROM}' THEN (total::decimal(18,1) + 0.5::decimal(2,1))::decimal(18,1)
               ELSE total::decimal(18,1) END)::varchar::double AS value
  FROM industry_cells
)"""

HEADLINE = "data_type = 'Seasonally adjusted' AND statistic_type = 'Estimate' AND NOT coalesce(is_suppressed, false)"

# Engagement: click = like, purchase = share, signup = comment, view = impression,
# and error is not an accepted kind. The number in props is the content.
EVENT_KINDS = {"click": "like", "purchase": "share", "signup": "comment", "view": "impression"}
KIND_CASES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_KINDS.items())


def engagement_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the fields of an engagement message; shares are delivered twice."""
    events = table(spark, sf, "events")
    kind, amount, user = F.col("event_type"), F.col("value"), F.col("user_id")
    mapped = F.lit(None).cast("string")
    for old, new in EVENT_KINDS.items():
        mapped = F.when(kind == old, new).otherwise(mapped)
    text_ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    content = F.concat(F.lit("c"), F.regexp_extract("props", "([0-9]+)", 1))
    one = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.coalesce(mapped, kind).alias("event_type"),
        F.when(amount >= 0.5, F.concat(F.lit("u"), user.cast("string"))).alias("user_id"),
        content.alias("content_id"),
        F.when(amount < 5, "video").when(amount < 10, "image").when(amount < 20, "text").when(amount < 50, "reel").otherwise("gif").alias("content_type"),
        F.concat(F.lit("a"), F.regexp_extract("props", "([0-9]+)", 1)).alias("creator_id"),
        F.when(amount < 3, "mobile_ios").when(amount < 8, "mobile_android").when(amount < 15, "desktop").otherwise("tablet").alias("device_type"),
        F.when(amount < 8, "ios_app").otherwise("web").alias("platform"),
        text_ts.alias("event_ts"),
        text_ts.alias("ingestion_ts"),
        F.concat(F.lit("s"), user.cast("string")).alias("session_id"),
        amount.alias("watch_duration"),
        F.lit(None).cast("int").alias("comment_length"),
    )
    times = F.when(F.col("event_type") == "share", 2).otherwise(1)
    return one.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def engagement_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The same events as a message log: key, value bytes and envelope."""
    events = engagement_events(spark, sf)
    body = F.to_json(F.struct(*EVENT_SCHEMA.names))
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit("engagement").alias("topic"),
        F.pmod(F.hash("user_id"), F.lit(6)).cast("int").alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.col("event_ts").cast("timestamp").alias("timestamp"),
    )


def message_log(spark: SparkSession, sf: str, label: str) -> str:
    """The messages stored as a log of several files, as a broker's partitions would be; gives the folder."""
    path = scratch_path(spark, f"{label}-log")
    append_table(engagement_messages(spark, sf).repartition("offset"), path)
    return path


ENGAGEMENT_ONCE = f"""
engagement_once AS (
  SELECT event_id::varchar AS event_id, CASE event_type {KIND_CASES} ELSE event_type END AS event_type,
         CASE WHEN value >= 0.5 THEN 'u' || user_id END AS user_id,
         'c' || regexp_extract(props, '([0-9]+)', 1) AS content_id,
         CASE WHEN value < 5 THEN 'video' WHEN value < 10 THEN 'image' WHEN value < 20 THEN 'text'
              WHEN value < 50 THEN 'reel' ELSE 'gif' END AS content_type,
         'a' || regexp_extract(props, '([0-9]+)', 1) AS creator_id,
         CASE WHEN value < 3 THEN 'mobile_ios' WHEN value < 8 THEN 'mobile_android'
              WHEN value < 15 THEN 'desktop' ELSE 'tablet' END AS device_type,
         CASE WHEN value < 8 THEN 'ios_app' ELSE 'web' END AS platform,
         ts AS event_ts, ts AS ingestion_ts, 's' || user_id AS session_id, value AS watch_duration
  FROM events
)"""
ENGAGEMENT = f"""{ENGAGEMENT_ONCE},
engagement AS (
  SELECT * FROM engagement_once UNION ALL SELECT * FROM engagement_once WHERE event_type = 'share'
)"""
GOOD_EVENT = """user_id IS NOT NULL AND event_ts IS NOT NULL
  AND event_type IN ('like', 'share', 'comment', 'impression', 'watch', 'save')
  AND content_type IN ('video', 'image', 'text', 'reel')"""
EVENT_FLAGS = """extract(hour FROM event_ts)::integer AS event_hour,
  device_type IN ('mobile_ios', 'mobile_android') AS is_mobile,
  content_type IN ('reel', 'video') AS is_viral_content_type"""

# Rentals: parts are listings, suppliers hosts, line items reviews.
ROOM_OF_TYPE = {"ECONOMY": "Shared room", "SMALL": "Private room", "STANDARD": "Hotel room"}


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    room = F.lit("Entire home/apt")
    for kind, name in ROOM_OF_TYPE.items():
        room = F.when(F.col("p_type") == kind, name).otherwise(room)
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return part.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("https://example.org/rooms/"), F.col("p_partkey").cast("string")).alias("listing_url"),
        F.col("p_name").alias("name"),
        room.alias("room_type"),
        (F.col("p_size") - 1).alias("minimum_nights"),
        F.col("p_size").cast("bigint").alias("host_id"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("decimal(10,2)").cast("string")).alias("price"),
        start.alias("created_at"),
        (start + F.make_dt_interval(days=F.col("p_size"))).alias("updated_at"),
    )


def raw_hosts(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return supplier.select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") >= 1000, F.col("s_name")).alias("name"),
        F.when(F.col("s_acctbal") > 5000, "t").otherwise("f").alias("is_superhost"),
        start.alias("created_at"),
        (start + F.make_dt_interval(days=F.col("s_nationkey"))).alias("updated_at"),
    )


def raw_reviews(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("listing_id"),
        F.col("l_shipdate").alias("date"),
        F.concat(F.lit("reviewer "), F.col("l_suppkey").cast("string")).alias("reviewer_name"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("stay "), F.col("l_orderkey").cast("string"))).alias("comments"),
        F.when(flag == "A", "positive").when(flag == "R", "negative").otherwise("neutral").alias("sentiment"),
    )


LISTINGS = """
raw_listings AS (
  SELECT p_partkey AS id, 'https://example.org/rooms/' || p_partkey AS listing_url, p_name AS name,
         CASE p_type WHEN 'ECONOMY' THEN 'Shared room' WHEN 'SMALL' THEN 'Private room'
              WHEN 'STANDARD' THEN 'Hotel room' ELSE 'Entire home/apt' END AS room_type,
         p_size - 1 AS minimum_nights, p_size::bigint AS host_id,
         '$' || p_retailprice::decimal(10,2) AS price, TIMESTAMP '2020-01-01' AS created_at,
         TIMESTAMP '2020-01-01' + to_days(p_size) AS updated_at
  FROM part
),
listings AS (
  SELECT id AS listing_id, name AS listing_name, room_type,
         CASE WHEN minimum_nights = 0 THEN 1 ELSE minimum_nights END AS minimum_nights, host_id,
         replace(price, '$', '')::decimal(10,2) AS price, created_at, updated_at
  FROM raw_listings
)"""
HOSTS = """
raw_hosts AS (
  SELECT s_suppkey AS id, CASE WHEN s_acctbal >= 1000 THEN s_name END AS name,
         CASE WHEN s_acctbal > 5000 THEN 't' ELSE 'f' END AS is_superhost, TIMESTAMP '2020-01-01' AS created_at,
         TIMESTAMP '2020-01-01' + to_days(s_nationkey) AS updated_at
  FROM supplier
),
hosts AS (
  SELECT id AS host_id, coalesce(name, 'Anonymous') AS host_name, is_superhost, created_at, updated_at FROM raw_hosts
)"""
REVIEWS = """
reviews AS (
  SELECT l_partkey AS listing_id, l_shipdate AS review_date, 'reviewer ' || l_suppkey AS reviewer_name,
         'stay ' || l_orderkey AS review_text,
         CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END AS review_sentiment
  FROM lineitem WHERE l_discount > 0
)"""
MOONS = """
moons AS (
  SELECT DISTINCT (TIMESTAMP '1995-01-16 20:26:00' + to_minutes(42524 * n))::date AS full_moon_date
  FROM range(0, 3000) t(n)
)"""
WITH_HOSTS = f"""{LISTINGS},{HOSTS},
joined AS (
  SELECT l.listing_id, l.listing_name, l.room_type, l.minimum_nights, l.price, l.host_id, h.host_name,
         h.is_superhost AS host_is_superhost, l.created_at,
         CASE WHEN h.updated_at IS NOT NULL THEN greatest(l.updated_at, h.updated_at) END AS updated_at
  FROM listings l LEFT JOIN hosts h ON h.host_id = l.host_id
)"""
