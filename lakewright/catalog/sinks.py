"""Sinks: each query writes, reads back and returns what was stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.catalog.streams import stored_stream
from lakewright.functions.keys import hash_key
from lakewright.operators.history import prepare_versions
from lakewright.operators.incremental import new_since
from lakewright.operators.projections import add_period_columns
from lakewright.operators.windows import keep_latest
from lakewright.plans.engagement import EVENT_SCHEMA
from lakewright.session import scratch_path
from lakewright.sinks.tables import (
    append_table,
    audit_rows,
    materialize,
    overwrite_partitions,
    overwrite_table,
    publish_version,
    register_table,
    reused,
    write_verified,
)
from lakewright.sources.files import read_table
from lakewright.sources.streams import table_stream
from lakewright.streaming.events import clean_events, start_upsert
from lakewright.streaming.ingest import parse_messages, run_available, start_append

PERIOD_TOTALS = """SELECT strftime(o_orderdate, '%Y') AS order_year, strftime(o_orderdate, '%m') AS order_month, count(*) AS n_rows,
  sum(o_totalprice::decimal(18,2))::double AS total FROM orders GROUP BY 1, 2"""


def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    return add_period_columns(table(spark, sf, "orders"), "o_orderdate", "order")


def period_totals(stored: DataFrame) -> DataFrame:
    return stored.groupBy("order_year", "order_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query("snk_01_partitioned_overwrite", PERIOD_TOTALS)
def partitioned_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "by-period")
    orders = dated_orders(spark, sf)
    overwrite_table(orders, path, ["order_year", "order_month"])
    return period_totals(read_table(spark, path, orders.schema))


@query(
    "snk_02_initial_dimension",
    """SELECT is_current, count(*) AS n_rows, count(DISTINCT o_custkey) AS customers, count(end_date) AS with_end FROM (
         SELECT o_custkey, true AS is_current, NULL::date AS end_date FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       GROUP BY is_current""",
)
def initial_dimension(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "dimension")
    orders = table(spark, sf, "orders")
    latest = keep_latest(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderpriority")
    as_of = orders.agg(F.max("o_orderdate").cast("date").alias("d")).first()["d"]
    versions = prepare_versions(latest, ["o_custkey"], as_of)
    overwrite_table(versions, path, ["is_current"])
    return read_table(spark, path, versions.schema).groupBy("is_current").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("o_custkey").alias("customers"),
        F.count("end_date").alias("with_end"),
    )


@query("snk_03_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def appended(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "append")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    closed = F.col("o_orderstatus") == "F"
    append_table(orders.filter(closed), path)
    append_table(orders.filter(~closed), path)
    return read_table(spark, path)


@query("snk_05_stream_append", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    events = table(spark, sf, "events")
    stream = stored_stream(spark, sf, "events").drop("props")
    run_available(start_append(stream, out, checkpoint, every=None))
    return read_table(spark, out)


@query(
    "snk_06_stream_upsert",
    f"""WITH {s.ENGAGEMENT_ONCE}
        SELECT event_id, event_type, user_id, content_id, event_ts, {s.EVENT_FLAGS} FROM engagement_once WHERE {s.GOOD_EVENT}""",
)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of the messages, one after the other; the second adds nothing."""
    log = s.message_log(spark, sf, "upsert")
    out, checkpoint = scratch_path(spark, "upsert-out"), scratch_path(spark, "upsert-state")
    messages = read_table(spark, log)
    for delivery in (1, 2):
        if delivery == 2:
            append_table(messages, log)
        stream = table_stream(spark, log, messages.schema, max_files=100)
        events = clean_events(parse_messages(stream, EVENT_SCHEMA)).withColumn("event_day", F.to_date("event_ts"))
        ties = ["ingestion_ts", "content_id"]
        run_available(start_upsert(events, out, checkpoint, ["event_id"], "event_ts", ties, ["event_day"], every=None))
    return read_table(spark, out).select(
        "event_id", "event_type", "user_id", "content_id", "event_ts", "event_hour", "is_mobile", "is_viral_content_type"
    )


@query("snk_07_catalog_registration", PERIOD_TOTALS)
def catalog_registration(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "registered")
    orders, periods = dated_orders(spark, sf), ["order_year", "order_month"]
    overwrite_table(orders, path, periods)
    return period_totals(register_table(spark, "orders_by_period", path, orders.schema, periods, replace=True))


@query("snk_08_verified_write", "SELECT count(*) AS verified_rows, count(*) AS stored_rows FROM lineitem")
def verified_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "verified")
    rows = write_verified(table(spark, sf, "lineitem"), path)
    return read_table(spark, path).agg(F.lit(rows).cast("bigint").alias("verified_rows"), F.count(F.lit(1)).alias("stored_rows"))


@query(
    "snk_09_materialisations",
    """SELECT mode, count(*) AS n_rows, sum(c_acctbal::decimal(18,2))::double AS total
       FROM customer, (VALUES ('view'), ('table'), ('ephemeral'), ('incremental')) m(mode) GROUP BY mode""",
)
def materialisations(spark: SparkSession, sf: str) -> DataFrame:
    """One model in four modes; the incremental one runs twice and appends nothing the second time."""
    model = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    path, inc_path = scratch_path(spark, "model"), scratch_path(spark, "model-inc")

    def missing(target: DataFrame, fresh: DataFrame) -> DataFrame:
        return new_since(target, fresh, "c_custkey")

    frames = {
        "view": materialize(model, "customer_model_view", "view"),
        "table": materialize(model, "customer_model", "table", path),
        "ephemeral": materialize(model, "customer_model_inline", "ephemeral"),
        "incremental": materialize(model, "customer_model_inc", "incremental", inc_path),
    }
    frames["incremental"] = materialize(model, "customer_model_inc", "incremental", inc_path, merge=missing)
    total = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    parts = [df.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n_rows"), total.alias("total")) for mode, df in frames.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "snk_10_run_audit",
    """SELECT 'orders_model' AS model_name, max(o_orderdate) AS run_time FROM orders
       UNION ALL SELECT 'lineitem_model', max(l_shipdate) FROM lineitem""",
)
def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    """An audit row appended after each model; the newest row of the model stands for the clock."""
    path = scratch_path(spark, "audit")
    for name, source, at in (("orders_model", "orders", "o_orderdate"), ("lineitem_model", "lineitem", "l_shipdate")):
        newest = table(spark, sf, source).agg(F.max(at).alias("t")).first()["t"]
        append_table(audit_rows(spark, {name: newest}), path)
    return read_table(spark, path)


@query(
    "snk_11_reused_intermediate",
    """SELECT l_returnflag, count(*) AS n_rows, (SELECT count(*) FROM lineitem) AS all_rows FROM lineitem GROUP BY l_returnflag""",
)
def reused_intermediate(spark: SparkSession, sf: str) -> DataFrame:
    """A costly frame kept while two results are written from it."""
    path, total_path = scratch_path(spark, "reused"), scratch_path(spark, "reused-total")
    items = table(spark, sf, "lineitem").select("l_returnflag", hash_key(["l_orderkey", "l_linenumber"]).alias("line_key"))
    with reused(items) as kept:
        overwrite_table(kept.groupBy("l_returnflag").agg(F.count("line_key").alias("n_rows")), path)
        overwrite_table(kept.agg(F.count("line_key").alias("all_rows")), total_path)
    all_rows = read_table(spark, total_path).select("all_rows").scalar()
    return read_table(spark, path).withColumn("all_rows", all_rows)


@query(
    "snk_12_partition_refresh",
    """SELECT strftime(o_orderdate, '%Y') AS order_year, count(*) AS n_rows,
              count(*) FILTER (WHERE strftime(o_orderdate, '%Y') = (SELECT strftime(max(o_orderdate), '%Y') FROM orders)) AS refreshed
       FROM orders GROUP BY 1""",
)
def partition_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Only the newest year is written again; the other partitions stay."""
    path = scratch_path(spark, "refresh")
    orders = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("order_year"))
    first = orders.withColumn("batch", F.lit(1))
    overwrite_table(first, path, ["order_year"])
    newest = orders.agg(F.max("order_year").alias("y")).first()["y"]
    overwrite_partitions(orders.filter(F.col("order_year") == newest).withColumn("batch", F.lit(2)), path, ["order_year"])
    return read_table(spark, path, first.schema).groupBy("order_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("batch") == 2).alias("refreshed")
    )


@query("snk_13_published_version", "SELECT o_orderpriority, 2 * count(*) AS n_rows FROM orders GROUP BY o_orderpriority")
def published_version(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by a frame computed from itself: new folder first, then the view moves."""
    root = scratch_path(spark, "published")
    publish_version(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), root, "published_orders")
    doubled = spark.table("published_orders").unionByName(spark.table("published_orders"))
    publish_version(doubled, root, "published_orders")
    return spark.table("published_orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"))
