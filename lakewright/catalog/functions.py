"""Scalar functions, each applied to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.catalog.sources import FEATURES, NAMES
from lakewright.functions import classify, dates, keys, numbers, text
from lakewright.streaming.features import user_features


@query(
    "fn_01_month_start",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN date_trunc('month', o_orderdate)::date::varchar END AS month_start FROM orders""",
)
def month_start(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    return table(spark, sf, "orders").select("o_orderkey", dates.month_start_from_text(raw).alias("month_start"))


@query("fn_02_year_month_text", "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem")
def year_month(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", dates.year_month_text(raw).alias("ship_month"))


@query("fn_03_iso_timestamp", "SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS event_ts FROM events")
def iso(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "xx").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return table(spark, sf, "events").select("event_id", dates.iso_timestamp(raw).alias("event_ts"))


@query("fn_04_hour", "SELECT event_id, extract(hour FROM ts)::integer AS event_hour FROM events")
def hour_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.hour("ts").alias("event_hour"))


@query(
    "fn_05_date_arithmetic",
    """SELECT o_orderkey, o_orderdate::date::varchar AS order_day, (o_orderdate::date + 1)::varchar AS next_day,
              (o_orderdate::date - 1)::varchar AS day_before, (DATE '2002-01-01' - o_orderdate::date)::integer AS age_days FROM orders""",
)
def date_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        day.alias("order_day"),
        F.date_add(day, 1).alias("next_day"),
        F.date_sub(day, 1).alias("day_before"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
    )


@query(
    "fn_06_five_minute_window",
    """SELECT event_id, time_bucket(INTERVAL '5 minutes', ts) AS window_start, time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
              date_trunc('minute', ts) - to_minutes(extract(minute FROM ts) % 5) AS by_minutes FROM events""",
)
def five_minute_window(spark: SparkSession, sf: str) -> DataFrame:
    window = dates.tumbling(F.col("ts"))
    return table(spark, sf, "events").withColumn("w", window).select(
        "event_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        dates.floor_to_minutes(F.col("ts"), 5).alias("by_minutes"),
    )


@query(
    "fn_07_null_default",
    """SELECT s_suppkey, coalesce(CASE WHEN s_acctbal >= 1000 THEN s_name END, 'Anonymous') AS host_name,
              coalesce(CASE WHEN s_acctbal >= 1000 THEN s_name END, 'N/A') AS host_name_v2 FROM supplier""",
)
def null_default(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("s_acctbal") >= 1000, F.col("s_name"))
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        F.coalesce(name, F.lit("Anonymous")).alias("host_name"),
        F.coalesce(name, F.lit("N/A")).alias("host_name_v2"),
    )


@query(
    "fn_08_null_if_zero_division",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / nullif(l_tax * 100, 0) AS per_tax FROM lineitem""",
)
def null_if_zero_division(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.try_divide("l_quantity", F.col("l_tax") * 100).alias("per_tax")
    )


@query(
    "fn_09_later_of_two",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN greatest(o_orderdate, TIMESTAMP '1998-06-01') END AS updated_at FROM orders""",
)
def later_of_two(spark: SparkSession, sf: str) -> DataFrame:
    first = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.later_of(first, F.lit("1998-06-01").cast("timestamp_ntz")).alias("updated_at")
    )


@query(
    "fn_10_rounding",
    """SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice / 7)::decimal(38,10), 1)::double AS one_place,
              round((l_extendedprice / 7)::decimal(38,10), 2)::double AS two_places FROM lineitem""",
)
def rounding(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("l_extendedprice") / 7
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.rounded(value, 1).alias("one_place"), numbers.rounded(value, 2).alias("two_places")
    )


@query(
    "fn_11_engagement_score",
    f"WITH {FEATURES.format(width='1 hour')} SELECT user_id, window_start, window_end, total_likes, total_shares, total_comments, total_impressions, engagement_score FROM scored",
)
def score(spark: SparkSession, sf: str) -> DataFrame:
    return user_features(table(spark, sf, "events"), "ts", width="1 hour", names=NAMES).drop("content_virality")


@query(
    "fn_12_virality",
    f"WITH {FEATURES.format(width='1 hour')} SELECT user_id, window_start, content_virality FROM scored",
)
def virality_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return user_features(table(spark, sf, "events"), "ts", width="1 hour", names=NAMES).select("user_id", "window_start", "content_virality")


@query(
    "fn_13_money_text",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice::decimal(10,2)::double AS plain,
              l_extendedprice::decimal(10,2)::double AS with_commas,
              CASE WHEN l_extendedprice < 1000 THEN l_extendedprice::decimal(10,2)::double END AS commas_unread FROM lineitem""",
)
def money_text(spark: SparkSession, sf: str) -> DataFrame:
    plain = F.concat(F.lit("$"), F.col("l_extendedprice").cast("decimal(10,2)").cast("string"))
    commas = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.money(plain).alias("plain"),
        numbers.money(commas, thousands=True).alias("with_commas"),
        numbers.money(commas).alias("commas_unread"),
    )


@query(
    "fn_14_regex_match",
    r"""SELECT c_custkey, regexp_matches(CASE WHEN c_acctbal < 0 THEN '' ELSE '$' END || c_acctbal::decimal(10,2), '^\$[0-9][0-9\.]+$') AS is_price FROM customer""",
)
def regex_match(spark: SparkSession, sf: str) -> DataFrame:
    price = F.concat(F.when(F.col("c_acctbal") < 0, "").otherwise("$"), F.col("c_acctbal").cast("decimal(10,2)").cast("string"))
    return table(spark, sf, "customer").select("c_custkey", text.matches(price, text.PRICE_PATTERN).alias("is_price"))


@query(
    "fn_15_classification",
    f"""WITH g AS (SELECT c_custkey, CASE c_nationkey {s.GEO_CASES} ELSE 'NATION_' || c_nationkey END AS geo FROM customer)
        SELECT c_custkey, geo, CASE WHEN geo = 'Canada' THEN 'National' ELSE 'Province' END AS geo_level,
          CASE WHEN geo IN ('British Columbia', 'Alberta', 'Saskatchewan', 'Manitoba') THEN 'Western Canada'
               WHEN geo IN ('Ontario', 'Quebec') THEN 'Central Canada'
               WHEN geo IN ('New Brunswick', 'Nova Scotia', 'Prince Edward Island', 'Newfoundland and Labrador') THEN 'Atlantic Canada'
               WHEN geo = 'Canada' THEN 'National' ELSE 'Other' END AS geo_region FROM g""",
)
def classification(spark: SparkSession, sf: str) -> DataFrame:
    own = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    geos = table(spark, sf, "customer").select("c_custkey", s.geography(F.col("c_nationkey"), own).alias("geo"))
    return geos.withColumns({"geo_level": classify.geo_level(F.col("geo")), "geo_region": classify.geo_region(F.col("geo"))})


@query(
    "fn_15_minimum_nights",
    "SELECT p_partkey, CASE WHEN p_size - 1 = 0 THEN 1 ELSE p_size - 1 END AS minimum_nights FROM part",
)
def nights(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", classify.at_least_one(F.col("p_size") - 1).alias("minimum_nights"))


@query(
    "fn_16_sha256_key",
    """SELECT o_orderkey, sha256(concat_ws('|', coalesce(nullif(o_orderpriority, '5-LOW'), '_null_'), o_custkey::varchar, o_orderdate::date::varchar)) AS version_key FROM orders""",
)
def sha256_key(spark: SparkSession, sf: str) -> DataFrame:
    parts = [F.nullif("o_orderpriority", F.lit("5-LOW")), "o_custkey", F.to_date("o_orderdate")]
    return table(spark, sf, "orders").select("o_orderkey", keys.hash_key(parts).alias("version_key"))


@query(
    "fn_17_md5_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, md5(concat_ws('-', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar)) AS fact_key FROM lineitem",
)
def md5_key(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey"]
    return table(spark, sf, "lineitem").select(*columns, keys.hash_key(columns, "md5", "-", plain=True).alias("fact_key"))


@query("fn_18_json_parse", "SELECT event_id, CASE WHEN event_type <> 'error' THEN regexp_extract(props, '([0-9]+)', 1)::integer END AS k FROM events")
def json_parse(spark: SparkSession, sf: str) -> DataFrame:
    schema = StructType([StructField("k", IntegerType())])
    document = F.when(F.col("event_type") == "error", "{broken").otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", text.parsed(document, schema).getField("k").alias("k"))


@query("fn_19_decoded_bytes", "SELECT doc_id, text FROM documents")
def decoded_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.decoded(F.col("text").cast("binary")).alias("text"))


@query(
    "fn_20_code_flag",
    """SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'P' THEN '..' WHEN 'F' THEN 'x' END IN ('..', 'x'), false) AS is_suppressed,
              CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS value FROM orders""",
)
def code_flag(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "..").when(F.col("o_orderstatus") == "F", "x")
    flagged = table(spark, sf, "orders").withColumn("is_suppressed", classify.in_codes(status, classify.SUPPRESSION_CODES))
    return flagged.select("o_orderkey", "is_suppressed", classify.unless(F.col("is_suppressed"), F.col("o_totalprice")).alias("value"))


@query("fn_21_trim", "SELECT doc_id, lang, source FROM documents")
def trim(spark: SparkSession, sf: str) -> DataFrame:
    padded = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("  "), F.col("lang")).alias("lang"), F.concat(F.col("source"), F.lit("   ")).alias("source")
    )
    return padded.withColumns(text.trimmed(["lang", "source"]))


@query("fn_22_scaling", "SELECT l_orderkey, l_linenumber, l_partkey, round((l_tax * 1000)::decimal(38,10), 0)::double AS tax_thousandths FROM lineitem")
def scaling(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.scaled(F.col("l_tax")).alias("tax_thousandths")
    )


@query("fn_23_text_to_number", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS number FROM events")
def text_to_number(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "..").otherwise(F.col("value").cast("string"))
    return table(spark, sf, "events").select("event_id", numbers.to_number(raw).alias("number"))
