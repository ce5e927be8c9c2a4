"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.operators.aggregates import group_counts
from lakewright.operators.joins import enrich
from lakewright.operators.ordering import top_by_score
from lakewright.plans.engagement import EVENT_SCHEMA
from lakewright.session import scratch_path
from lakewright.sinks.tables import overwrite_table
from lakewright.sources.files import read_raw_csv, read_table, read_typed_csv
from lakewright.sources.names import Sources, view_over_path
from lakewright.sources.seeds import full_moons
from lakewright.sources.streams import table_stream
from lakewright.streaming.features import EventNames, user_features
from lakewright.streaming.ingest import parse_messages, run_available, start_append

NAMES = EventNames(like="click", share="purchase", comment="signup", impression="view")


@query(
    "src_01_header_csv",
    """SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey,
              c_acctbal::decimal(18,2)::varchar AS c_acctbal, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment
       FROM customer""",
)
def header_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "header-csv")
    rows = table(spark, sf, "customer").withColumns(
        {
            "c_acctbal": F.col("c_acctbal").cast("decimal(18,2)"),
            "c_mktsegment": F.nullif("c_mktsegment", F.lit("MACHINERY")),
        }
    )
    rows.write.option("header", True).option("nullValue", "").option("encoding", "UTF-8").csv(path)
    return read_raw_csv(spark, path)


@query("src_02_typed_csv", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def typed_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "typed-csv")
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", fmt).alias("o_orderdate"), "o_orderpriority"
    )
    orders.write.option("header", True).csv(path)
    schema = StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("o_custkey", LongType()),
            StructField("o_totalprice", DoubleType()),
            StructField("o_orderdate", TimestampNTZType()),
            StructField("o_orderpriority", StringType()),
        ]
    )
    return read_typed_csv(spark, path, schema, {"o_orderdate": fmt})


@query("src_03_table_by_path", "SELECT * FROM part")
def table_by_path(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/part.parquet")


@query(
    "src_04_named_sources",
    """SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def named_sources(spark: SparkSession, sf: str) -> DataFrame:
    sources = Sources(spark, {"geo.nations": f"{sf}/nation.parquet", "geo.regions": f"{sf}/region.parquet"})
    joined = enrich(sources.get("geo.nations"), sources.get("geo.regions"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"})
    return joined.select("n_nationkey", "n_name", "r_name")


@query(
    "src_05_view_over_path",
    "SELECT s_nationkey, count(*) AS suppliers, max(s_acctbal) AS best_balance FROM supplier GROUP BY s_nationkey",
)
def path_view(spark: SparkSession, sf: str) -> DataFrame:
    view_over_path(spark, "supplier_by_path", f"{sf}/supplier.parquet")
    return spark.sql(
        "SELECT s_nationkey, count(*) AS suppliers, max(s_acctbal) AS best_balance FROM supplier_by_path GROUP BY s_nationkey"
    )


@query(
    "src_06_message_stream",
    f"""WITH {s.ENGAGEMENT}
        SELECT event_type, count(*) AS messages, count(user_id) AS with_user, min(event_ts) AS first_ts, max(event_ts) AS last_ts
        FROM engagement GROUP BY event_type""",
)
def message_stream_shape(spark: SparkSession, sf: str) -> DataFrame:
    """A log of message bytes read as a stream; a broker gives the same columns."""
    log = s.message_log(spark, sf, "messages")
    out, checkpoint = scratch_path(spark, "messages-out"), scratch_path(spark, "messages-state")
    stream = table_stream(spark, log, read_table(spark, log).schema)
    run_available(start_append(parse_messages(stream, EVENT_SCHEMA), out, checkpoint, every=None))
    return (
        read_table(spark, out)
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.count("user_id").alias("with_user"),
            F.min(F.try_to_timestamp("event_ts")).alias("first_ts"),
            F.max(F.try_to_timestamp("event_ts")).alias("last_ts"),
        )
    )


@query("src_07_rate_limited_stream", "SELECT event_type, count(*) AS n_rows, max(event_id) AS last_id FROM events GROUP BY event_type")
def rate_limited_stream(spark: SparkSession, sf: str) -> DataFrame:
    log, out, checkpoint = (scratch_path(spark, f"limited-{n}") for n in ("log", "out", "state"))
    events = table(spark, sf, "events").select("event_id", "event_type")
    events.write.option("maxRecordsPerFile", 100_000).parquet(log)
    run_available(start_append(table_stream(spark, log, events.schema, max_files=10), out, checkpoint, every=None))
    return read_table(spark, out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last_id"))


@query(
    "src_08_seed_table",
    f"""WITH {s.MOONS}, days AS (SELECT o_orderdate::date AS d, count(*) AS n FROM orders GROUP BY 1)
        SELECT full_moon_date::varchar AS full_moon_date, coalesce(n, 0) AS orders
        FROM moons LEFT JOIN days ON d = full_moon_date
        WHERE full_moon_date BETWEEN (SELECT min(o_orderdate)::date FROM orders) AND (SELECT max(o_orderdate)::date FROM orders)""",
)
def seed_table(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    span = orders.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    moons = full_moons(spark, span["a"], span["b"])
    days = group_counts(orders, ["day"], "orders")
    return moons.join(days, F.col("day") == F.col("full_moon_date"), "left").select(
        "full_moon_date", F.coalesce("orders", F.lit(0)).alias("orders")
    )


FEATURES = """
features AS (
  SELECT user_id, time_bucket(INTERVAL '{width}', ts) AS window_start,
         count(*) FILTER (WHERE event_type = 'click') AS total_likes,
         count(*) FILTER (WHERE event_type = 'purchase') AS total_shares,
         count(*) FILTER (WHERE event_type = 'signup') AS total_comments,
         count(*) FILTER (WHERE event_type = 'view') AS total_impressions
  FROM events GROUP BY 1, 2
),
scored AS (
  SELECT *, window_start + INTERVAL '{width}' AS window_end,
         CASE WHEN total_impressions = 0 THEN 0
              ELSE round(((total_shares * 4 + total_comments * 3 + total_likes * 2 + total_impressions)::double
                          / total_impressions)::decimal(38,10), 4)::double END AS engagement_score,
         round((total_shares::double / nullif(total_impressions, 0))::decimal(38,10), 4)::double AS content_virality
  FROM features
)"""


@query(
    "src_09_feature_read",
    f"""WITH {FEATURES.format(width='1 day')}
        SELECT user_id, window_start, engagement_score, content_virality FROM scored
        ORDER BY engagement_score DESC NULLS FIRST, user_id, window_start LIMIT 1000""",
)
def feature_read(spark: SparkSession, sf: str) -> DataFrame:
    """The stored feature table read back, best thousand rows. Over JDBC the read is ``read_jdbc``."""
    path = scratch_path(spark, "features")
    overwrite_table(user_features(table(spark, sf, "events"), "ts", width="1 day", names=NAMES), path)
    rows = read_table(spark, path).select("user_id", "window_start", "engagement_score", "content_virality")
    return top_by_score(rows, "engagement_score", ["user_id", "window_start"], 1000)
