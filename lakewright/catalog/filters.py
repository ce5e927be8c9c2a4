"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.operators.filters import equals_all, has_keys, no_empty_strings, not_flagged, outside, positive, split_valid
from lakewright.plans.labour import headline


@query(
    "fil_01_conjunction",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_shipdate >= TIMESTAMP '1998-01-01'""",
)
def conjunction(spark: SparkSession, sf: str) -> DataFrame:
    wanted = equals_all({"l_returnflag": "R", "l_linestatus": "F"}) & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return table(spark, sf, "lineitem").filter(wanted).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@query("fil_02_inequality", "SELECT * FROM orders WHERE nullif(o_orderpriority, '1-URGENT') != '5-LOW'")
def inequality(spark: SparkSession, sf: str) -> DataFrame:
    """NULL is neither equal nor unequal, so such rows go as well."""
    return table(spark, sf, "orders").filter(F.nullif("o_orderpriority", F.lit("1-URGENT")) != "5-LOW")


@query(
    "fil_03_required_keys",
    f"WITH {s.ENGAGEMENT} SELECT event_id, user_id, content_id, event_type FROM engagement WHERE user_id IS NOT NULL",
)
def required_keys(spark: SparkSession, sf: str) -> DataFrame:
    return has_keys(s.engagement_events(spark, sf), ["event_id", "user_id", "content_id", "event_type"]).select(
        "event_id", "user_id", "content_id", "event_type"
    )


@query("fil_04_membership", "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase', 'view')")
def membership(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(F.col("event_type").isin("click", "purchase", "view")).select("event_id", "event_type", "value")


@query(
    "fil_05_null_safe_flag",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE NOT coalesce(CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END, false)""",
)
def null_safe_flag(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    flagged = table(spark, sf, "orders").withColumn("held", F.when(status == "P", True).when(status == "F", False))
    return flagged.filter(not_flagged("held")).select("o_orderkey", "o_totalprice")


@query("fil_06_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45")
def value_range(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").filter(outside("l_quantity", 5, 45)).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "fil_07_no_empty_strings",
    f"""WITH {s.HOSTS} SELECT id, name, is_superhost, created_at, updated_at FROM raw_hosts WHERE name IS NOT NULL AND name <> '' AND is_superhost <> ''""",
)
def filled_strings(spark: SparkSession, sf: str) -> DataFrame:
    hosts = s.raw_hosts(spark, sf)
    return hosts.filter(no_empty_strings(hosts))


@query("fil_08_positive_values", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def positive_values(spark: SparkSession, sf: str) -> DataFrame:
    return positive(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(
    "fil_09_routed_rejects",
    """SELECT coalesce(reason, 'valid') AS reason, count(*) AS n_rows, sum(o_totalprice::decimal(18,2))::double AS total FROM (
         SELECT *, CASE WHEN NOT coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED') IS NOT NULL, false) THEN 'no priority'
                        WHEN o_totalprice >= 400000 THEN 'too large' WHEN o_orderstatus = 'P' THEN 'pending' END AS reason
         FROM orders) GROUP BY 1""",
)
def routed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    valid, rejects = split_valid(
        table(spark, sf, "orders"),
        {
            "no priority": F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).isNotNull(),
            "too large": F.col("o_totalprice") < 400_000,
            "pending": F.col("o_orderstatus") != "P",
        },
    )
    both = valid.withColumn("reason", F.lit("valid")).unionByName(rejects.withColumnRenamed("_reject_reason", "reason"))
    return both.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query(
    "fil_01_headline_rows",
    f"""WITH {s.PROVINCE_CLEAN}
        SELECT ref_date::varchar AS ref_date, geo, labour_force_characteristic, gender, age_group, value
        FROM province WHERE {s.HEADLINE}""",
)
def headline_rows(spark: SparkSession, sf: str) -> DataFrame:
    return headline(s.province_clean(spark, sf)).select(
        "ref_date", "geo", "labour_force_characteristic", "gender", "age_group", "value"
    )
