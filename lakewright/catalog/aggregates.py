"""Aggregations, sorts, top-k reports and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog.base import query, table
from lakewright.catalog.sources import FEATURES, NAMES
from lakewright.operators.aggregates import (
    column_profile,
    counted,
    counts_by,
    dirty_number_stats,
    duplicate_count,
    group_counts,
    histogram,
    null_rates,
    repeated_keys,
    top_values,
    value_listing,
)
from lakewright.operators.ordering import first_rows, sorted_output, top_by_score
from lakewright.operators.ranks import exact_quantile
from lakewright.operators.sets import shared_values, table_difference, union_all
from lakewright.streaming.features import user_features


@query(
    "agg_01_counts_in_one_pass",
    """SELECT count(*) AS total_rows, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
              count(*) FILTER (WHERE l_discount > 0.05) AS discounted FROM lineitem""",
)
def counts_in_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    return counted(table(spark, sf, "lineitem"), {"returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.05})


@query(
    "agg_02_repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeated(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "agg_03_conditional_counts",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
              count(*) FILTER (WHERE event_type = 'signup') AS signups, count(*) FILTER (WHERE event_type = 'view') AS views
       FROM events GROUP BY user_id""",
)
def conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    wanted = {"clicks": "click", "purchases": "purchase", "signups": "signup", "views": "view"}
    return counts_by(table(spark, sf, "events"), ["user_id"], {name: kind == value for name, value in wanted.items()})


@query(
    "agg_04_two_column_counts",
    "SELECT l_returnflag, l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY ALL ORDER BY l_returnflag, l_linestatus",
)
def two_column_counts(spark: SparkSession, sf: str) -> DataFrame:
    return group_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"]).orderBy("l_returnflag", "l_linestatus")


@query("agg_05_scalar_bounds", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (SELECT min(o_orderdate) FROM orders)")
def scalar_bounds(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return orders.filter(F.col("o_orderdate") > orders.agg(F.min("o_orderdate").alias("m")).scalar())


@query("agg_06_distinct_rows", "SELECT DISTINCT lang, source FROM documents")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("lang", "source").distinct()


@query(
    "agg_07_distinct_count_on_key",
    """SELECT count(*) AS total_rows, count(DISTINCT text) AS distinct_rows, count(*) - count(DISTINCT text) AS duplicate_rows FROM documents""",
)
def distinct_on_key(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_count(table(spark, sf, "documents"), ["text"])


@query(
    "agg_08_null_rates",
    """WITH d AS (SELECT nullif(o_orderpriority, '5-LOW') AS o_orderpriority, nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderkey FROM orders)
       SELECT 'o_orderpriority' AS column_name, count(*) - count(o_orderpriority) AS null_count, count(*) AS total_rows,
              (count(*) - count(o_orderpriority))::double / count(*) AS null_rate FROM d
       UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus), count(*), (count(*) - count(o_orderstatus))::double / count(*) FROM d
       UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey), count(*), (count(*) - count(o_orderkey))::double / count(*) FROM d""",
)
def null_rate_rows(spark: SparkSession, sf: str) -> DataFrame:
    holes = table(spark, sf, "orders").withColumns(
        {"o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")), "o_orderstatus": F.nullif("o_orderstatus", F.lit("P"))}
    )
    return null_rates(holes, ["o_orderpriority", "o_orderstatus", "o_orderkey"])


@query("agg_09_having_without_group", "SELECT count(*) AS n_rows FROM supplier HAVING count(*) < 1000")
def having_without_group(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < 1000)


@query(
    "agg_10_mean_and_max",
    "SELECT round(avg(p_retailprice), 6) AS mean_price, max(p_retailprice) AS max_price FROM part",
)
def mean_and_max(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").agg(F.round(F.avg("p_retailprice"), 6).alias("mean_price"), F.max("p_retailprice").alias("max_price"))


@query("agg_11_distinct_values", "SELECT count(DISTINCT p_type) AS types, count(DISTINCT p_brand) AS brands FROM part")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").agg(F.countDistinct("p_type").alias("types"), F.countDistinct("p_brand").alias("brands"))


@query("agg_12_exact_quantile", "SELECT quantile_cont(l_extendedprice, 0.99) AS q99 FROM lineitem")
def quantile(spark: SparkSession, sf: str) -> DataFrame:
    return exact_quantile(table(spark, sf, "lineitem"), "l_extendedprice", 0.99, "q99")


PROFILE_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


def _profile_sql() -> str:
    parts = []
    for name, kind in PROFILE_TYPES.items():
        text = f"{name}::decimal(18,2)::varchar" if kind == "double" else f"{name}::varchar"
        parts.append(
            f"""SELECT '{name}' AS column_name, '{"string" if kind == "double" else kind}' AS data_type, count(*) AS total_rows,
                count(*) - count({name}) AS null_count, (count(*) - count({name})) * 100.0::double / count(*) AS null_pct,
                array_to_string(list_distinct([min({text}), arg_min({text}, md5({text})), max({text})]).list_sort(), ' | ') AS samples FROM orders"""
        )
    return " UNION ALL ".join(parts)


@query("agg_13_table_profile", _profile_sql())
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return column_profile(orders).withColumn("samples", F.array_join(F.array_sort("samples"), " | "))


@query(
    "agg_13_value_listing",
    """SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n_rows FROM orders GROUP BY 2
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""",
)
def listing(spark: SparkSession, sf: str) -> DataFrame:
    return value_listing(table(spark, sf, "orders"), 20)


@query("agg_14_top_values", "SELECT source, count(*) AS n_rows FROM documents GROUP BY source ORDER BY n_rows DESC, source LIMIT 15")
def most_frequent(spark: SparkSession, sf: str) -> DataFrame:
    return top_values(table(spark, sf, "documents"), "source", 15)


@query("agg_14_top_parts", "SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY l_partkey ORDER BY n_rows DESC, l_partkey LIMIT 15")
def most_frequent_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are about equally frequent, among which a sketch cannot choose."""
    return top_values(table(spark, sf, "lineitem"), "l_partkey", 15, tracked=200)


@query(
    "agg_15_dirty_numbers",
    """WITH d AS (SELECT try_cast(CASE WHEN event_type = 'error' THEN '..' ELSE value::decimal(18,2)::varchar END AS double) AS v FROM events)
       SELECT min(v) AS min_value, max(v) AS max_value, sum(v::decimal(18,4))::double / count(v) AS mean_value, count(*) - count(v) AS null_count FROM d""",
)
def dirty_numbers(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "..").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    return dirty_number_stats(table(spark, sf, "events").select(text.alias("v")), "v")


@query(
    "agg_16_histogram",
    """WITH b AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
       SELECT least(floor((l_quantity - lo) / ((hi - lo) / 50)), 49)::integer AS bin, count(*) AS n_rows,
              any_value(lo + least(floor((l_quantity - lo) / ((hi - lo) / 50)), 49) * ((hi - lo) / 50)) AS bin_start,
              any_value(lo + (least(floor((l_quantity - lo) / ((hi - lo) / 50)), 49) + 1) * ((hi - lo) / 50)) AS bin_end
       FROM lineitem, b GROUP BY 1""",
)
def equal_width_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return histogram(table(spark, sf, "lineitem"), "l_quantity", 50)


@query("top_01_sorted_sample", "SELECT s_nationkey, s_suppkey, s_name FROM supplier ORDER BY s_nationkey, s_suppkey, s_name LIMIT 10")
def sorted_sample(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["s_nationkey", "s_suppkey", "s_name"]
    return first_rows(table(spark, sf, "supplier").select(*columns), columns, 10)


@query(
    "top_02_most_recent",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey LIMIT 5",
)
def most_recent(spark: SparkSession, sf: str) -> DataFrame:
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return first_rows(urgent.select("o_orderkey", "o_orderdate", "o_totalprice"), [F.desc("o_orderdate"), "o_orderkey"], 5)


@query(
    "top_03_failing_sample",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 10",
)
def failing_sample(spark: SparkSession, sf: str) -> DataFrame:
    return first_rows(table(spark, sf, "customer").filter("c_acctbal < 0").select("c_custkey", "c_acctbal"), ["c_custkey"], 10)


@query(
    "top_04_best_by_score",
    f"""WITH {FEATURES.format(width='5 minutes')}
        SELECT user_id, window_start, total_shares, content_virality FROM scored ORDER BY content_virality DESC NULLS FIRST, user_id, window_start LIMIT 1000""",
)
def best_by_score(spark: SparkSession, sf: str) -> DataFrame:
    features = user_features(table(spark, sf, "events"), "ts", names=NAMES)
    return top_by_score(features, "content_virality", ["user_id", "window_start"], 1000).select(
        "user_id", "window_start", "total_shares", "content_virality"
    )


@query(
    "top_05_sorted_groups",
    "SELECT c_nationkey, c_mktsegment, count(*) AS n_rows FROM customer GROUP BY ALL ORDER BY c_nationkey, c_mktsegment",
)
def sorted_groups(spark: SparkSession, sf: str) -> DataFrame:
    return sorted_output(group_counts(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"]), ["c_nationkey", "c_mktsegment"])


@query(
    "set_01_union_all",
    """SELECT c_custkey AS party_key, c_name AS party_name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def union_of_parties(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("party_name"), F.col("s_suppkey").alias("party_key")
    )
    return union_all(customers, suppliers)


@query(
    "set_02_shared_values",
    """SELECT count(*) AS shared, min(m) AS first_shared, max(m) AS last_shared FROM (
         SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders INTERSECT SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem)""",
)
def shared_months(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    items = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    return shared_values(orders, items, "month")


@query(
    "set_03_table_difference",
    """WITH e AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
            a AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2)
       SELECT l_orderkey, l_linenumber, e.n AS expected_rows, coalesce(a.n, 0) AS actual_rows
       FROM e LEFT JOIN a USING (l_orderkey, l_linenumber) WHERE e.n <> coalesce(a.n, 0)""",
)
def difference(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    return table_difference(items, items.filter(F.col("l_returnflag") != "A"), ["l_orderkey", "l_linenumber"])
