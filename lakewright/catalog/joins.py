"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.functions.classify import geo_level
from lakewright.operators.history import scd2_from_log
from lakewright.operators.incremental import insert_if_absent
from lakewright.operators.joins import (
    absent_rows,
    changed_rows,
    enrich,
    flag_dates,
    match_counts,
    orphans,
    pit_join,
    update_matched,
)
from lakewright.operators.windows import keep_latest
from lakewright.plans.rentals import full_moon_reviews, hosts_cleansed, listings_cleansed, listings_with_hosts, review_fact
from lakewright.sources.seeds import full_moons, yearly_holidays

TRACKED = ["o_orderpriority", "o_orderstatus"]

# Version history of each customer: the last order of a day sets the state.
HISTORY = """
daily AS (
  SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate::date AS effective_date FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::date ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
),
changes AS (
  SELECT * FROM daily
  WINDOW w AS (PARTITION BY o_custkey ORDER BY effective_date)
  QUALIFY lag(effective_date) OVER w IS NULL
       OR lag(o_orderpriority) OVER w <> o_orderpriority OR lag(o_orderstatus) OVER w <> o_orderstatus
),
history AS (
  SELECT *, lead(effective_date) OVER (PARTITION BY o_custkey ORDER BY effective_date) - 1 AS end_date,
         lead(effective_date) OVER (PARTITION BY o_custkey ORDER BY effective_date) IS NULL AS is_current
  FROM changes
)"""


def customer_history(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_from_log(table(spark, sf, "orders"), ["o_custkey"], TRACKED, "o_orderdate", ["o_orderkey"])


def shipped_items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their order's customer: the facts that look for a version."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", F.to_date("l_shipdate").alias("ship_day")
    )


PIT_SQL = f"""WITH {HISTORY}
SELECT l_orderkey, l_linenumber, l_partkey, o.o_custkey, l_shipdate::date::varchar AS ship_day,
       h.o_orderpriority AS priority_then, h.effective_date::varchar AS version_from
FROM lineitem JOIN orders o ON l_orderkey = o.o_orderkey
LEFT JOIN history h ON h.o_custkey = o.o_custkey AND l_shipdate::date >= h.effective_date
  AND (h.is_current OR l_shipdate::date <= h.end_date)"""
TAKE = {"o_orderpriority": "priority_then", "effective_date": "version_from"}


def _point_in_time(spark: SparkSession, sf: str, method: str) -> DataFrame:
    return pit_join(shipped_items(spark, sf), customer_history(spark, sf), ["o_custkey"], "ship_day", TAKE, method=method)


@query(
    "jon_01_two_key_left_join",
    """WITH m AS (SELECT o_custkey, o_orderdate::date AS d, o_orderkey FROM orders),
            t AS (SELECT o_custkey, o_orderdate::date AS d, sum(o_totalprice::decimal(18,2))::double AS day_total
                  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2)
       SELECT m.o_orderkey, m.o_custkey, m.d::varchar AS order_day, t.day_total
       FROM m LEFT JOIN t ON m.o_custkey = t.o_custkey AND m.d = t.d""",
)
def two_key_left_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("order_day", F.to_date("o_orderdate"))
    totals = (
        orders.filter(F.col("o_orderstatus") != "P")
        .groupBy("o_custkey", "order_day")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("day_total"))
    )
    return orders.select("o_orderkey", "o_custkey", "order_day").join(totals, ["o_custkey", "order_day"], "left")


@query(
    "jon_02_dimension_enrichment",
    """SELECT c_custkey, c_nationkey, n_name AS nation, CASE WHEN n_name = 'Canada' THEN 'National' ELSE 'Province' END AS geo_level
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def dimension_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "nation").withColumn("geo_level", geo_level(F.col("n_name")))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return enrich(customers, dim, {"c_nationkey": "n_nationkey"}, {"n_name": "nation", "geo_level": "geo_level"})


@query("jon_03_point_in_time", PIT_SQL)
def point_in_time(spark: SparkSession, sf: str) -> DataFrame:
    return _point_in_time(spark, sf, "auto")


@query("jon_03_point_in_time_salted", PIT_SQL)
def point_in_time_salted(spark: SparkSession, sf: str) -> DataFrame:
    return _point_in_time(spark, sf, "salted")


@query("jon_03_point_in_time_monthly", PIT_SQL)
def point_in_time_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _point_in_time(spark, sf, "monthly")


@query("jon_03_point_in_time_sweep", PIT_SQL)
def point_in_time_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _point_in_time(spark, sf, "sweep")


@query(
    "jon_03_point_in_time_half_open",
    f"""WITH {HISTORY} SELECT o.o_orderkey, h.effective_date::varchar AS version_from FROM orders o
        LEFT JOIN history h ON h.o_custkey = o.o_custkey AND o.o_orderdate::date >= h.effective_date
         AND (h.is_current OR o.o_orderdate::date < h.end_date)""",
)
def point_in_time_half_open(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return pit_join(
        orders, customer_history(spark, sf), ["o_custkey"], "day", {"effective_date": "version_from"}, end_inclusive=False
    ).select("o_orderkey", "version_from")


@query(
    "jon_04_match_audit",
    f"""WITH {HISTORY} SELECT count(h.o_custkey) AS matched, count(*) - count(h.o_custkey) AS unmatched
        FROM lineitem JOIN orders o ON l_orderkey = o.o_orderkey
        LEFT JOIN history h ON h.o_custkey = o.o_custkey AND l_shipdate::date - 60 >= h.effective_date
         AND (h.is_current OR l_shipdate::date - 60 <= h.end_date)""",
)
def match_audit(spark: SparkSession, sf: str) -> DataFrame:
    items = shipped_items(spark, sf).withColumn("asked", F.date_sub("ship_day", 60))
    joined = pit_join(items, customer_history(spark, sf), ["o_custkey"], "asked", {"effective_date": "version_from"})
    return match_counts(joined, "version_from")


# State of each customer before and after a cut in time.
CUTS = """
at_first AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
),
at_second AS (
  SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
)"""


def at_first(spark: SparkSession, sf: str) -> DataFrame:
    before = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return keep_latest(before, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderkey", *TRACKED)


def at_second(spark: SparkSession, sf: str) -> DataFrame:
    latest = keep_latest(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_orderstatus")


@query(
    "jon_05_changed_rows",
    f"""WITH {CUTS} SELECT n.* FROM at_second n JOIN at_first o USING (o_custkey)
        WHERE n.o_orderpriority IS DISTINCT FROM o.o_orderpriority OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus""",
)
def changed(spark: SparkSession, sf: str) -> DataFrame:
    return changed_rows(at_second(spark, sf), at_first(spark, sf), ["o_custkey"], TRACKED)


@query(
    "jon_06_new_entities",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
         SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""",
)
def new_entities(spark: SparkSession, sf: str) -> DataFrame:
    known = (
        table(spark, sf, "orders")
        .filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return absent_rows(table(spark, sf, "customer").select("c_custkey", "c_name"), known, ["c_custkey"])


@query(
    "jon_07_orphans",
    """SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'
       AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value < 20)""",
)
def orphan_values(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    buyers = events.filter(F.col("event_type") == "purchase")
    members = events.filter((F.col("event_type") == "signup") & (F.col("value") < 20))
    return orphans(buyers, "user_id", members, "user_id")


@query("jon_08_latest_of_two", f"WITH {s.WITH_HOSTS} SELECT listing_id, host_name, updated_at FROM joined")
def latest_of_two(spark: SparkSession, sf: str) -> DataFrame:
    joined = listings_with_hosts(listings_cleansed(s.raw_listings(spark, sf)), hosts_cleansed(s.raw_hosts(spark, sf)))
    return joined.select("listing_id", "host_name", "updated_at")


@query(
    "jon_09_shifted_date",
    f"""WITH {s.REVIEWS},{s.MOONS}
        SELECT r.*, CASE WHEN full_moon_date IS NULL THEN 'not full moon' ELSE 'full moon' END AS is_full_moon
        FROM reviews r LEFT JOIN moons ON review_date::date = full_moon_date + 1""",
)
def shifted_date(spark: SparkSession, sf: str) -> DataFrame:
    reviews = review_fact(s.raw_reviews(spark, sf))
    span = reviews.agg(F.date_sub(F.min(F.to_date("review_date")), 1).alias("a"), F.max(F.to_date("review_date")).alias("b")).first()
    return full_moon_reviews(reviews, full_moons(spark, span["a"], span["b"]))


@query(
    "jon_10_update_matched",
    f"""WITH {CUTS} SELECT t.o_custkey, t.o_orderkey,
          CASE WHEN s.o_custkey IS NOT NULL AND s.o_orderstatus IS DISTINCT FROM t.o_orderstatus THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
          CASE WHEN s.o_custkey IS NOT NULL AND s.o_orderstatus IS DISTINCT FROM t.o_orderstatus THEN 'expired' ELSE t.o_orderpriority END AS o_orderpriority
        FROM at_first t LEFT JOIN at_second s ON t.o_custkey = s.o_custkey""",
)
def updated_matched(spark: SparkSession, sf: str) -> DataFrame:
    return update_matched(
        at_first(spark, sf),
        at_second(spark, sf),
        ["o_custkey"],
        ~F.col("s.o_orderstatus").eqNullSafe(F.col("t.o_orderstatus")),
        {"o_orderstatus": F.col("s.o_orderstatus"), "o_orderpriority": F.lit("expired")},
    )


@query(
    "jon_11_insert_not_matched",
    f"""WITH {CUTS} SELECT * FROM at_first UNION ALL SELECT * FROM at_second WHERE o_custkey NOT IN (SELECT o_custkey FROM at_first)""",
)
def insert_not_matched(spark: SparkSession, sf: str) -> DataFrame:
    return insert_if_absent(at_first(spark, sf), at_second(spark, sf), ["o_custkey"], "o_orderkey", ["o_orderstatus"])


@query(
    "jon_12_calendar_flag",
    """SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%m-%d') IN ('01-01', '05-01', '10-03', '12-25', '12-26') AS is_holiday FROM orders""",
)
def calendar_flag(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    span = orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")).first()
    holidays = yearly_holidays(spark, span["a"], span["b"], [(1, 1), (5, 1), (10, 3), (12, 25), (12, 26)])
    return flag_dates(orders, "o_orderdate", holidays, "holiday_date", "is_holiday")
