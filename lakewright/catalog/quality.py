"""Data-quality checks; the result rows are the query result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.operators.aggregates import counted
from lakewright.operators.quality import (
    Check,
    contract_checks,
    enforced,
    failing_rows,
    gate,
    query_test,
    run_suite,
    schema_differences,
    store_failures,
)
from lakewright.plans.labour import dimension_history, geo_dimension, headline, mart_checks, monthly_fact, trend_mart
from lakewright.plans.rentals import ROOM_TYPES, hosts_cleansed, listings_cleansed, listings_with_hosts
from lakewright.session import scratch_path
from lakewright.sinks.tables import ConstraintBroken, latest_version, publish_version
from lakewright.sources.files import read_table

AS_OF = datetime(2002, 1, 1)


def _row(table_name: str, check: str, source: str, passed: str, observed: str, failing: str = "0", severity: str = "error") -> str:
    """SQL of one result row computed from ``source``."""
    bad = "WARN" if severity == "warn" else "FAIL"
    return f"""SELECT '{table_name}' AS table_name, '{check}' AS check_name, '{severity}' AS severity,
      CASE WHEN {passed} THEN 'PASS' ELSE '{bad}' END AS status, ({observed})::double AS observed, ({failing})::bigint AS failing_rows FROM {source}"""


def _bad(table_name: str, check: str, source: str, condition: str, severity: str = "error") -> str:
    n = f"count(*) FILTER (WHERE {condition})"
    return _row(table_name, check, source, f"{n} = 0", n, n, severity)


def _rows(spark: SparkSession, sf: str, names: list[str], checks: list[Check], as_of: datetime | None = None) -> DataFrame:
    return run_suite({name: table(spark, sf, name) for name in names}, checks, as_of)


@query(
    "dq_01_row_reconciliation",
    _row("orders", "covers_lineitem", "(SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS b)", "a >= b", "a", "greatest(b - a, 0)"),
)
def row_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """At least as many orders as distinct order keys upstream."""
    check = Check("orders", "covers_lineitem", "at_least_count", args={"other": "lineitem", "distinct_on": ["l_orderkey"]})
    return _rows(spark, sf, ["orders", "lineitem"], [check])


@query(
    "dq_02_null_rate",
    " UNION ALL ".join(
        [
            _row("orders", "status_null_rate", "orders", "avg((o_orderstatus = 'P')::int) <= 0.3", "(count(*) FILTER (WHERE o_orderstatus = 'P'))::double / count(*)", "count(*) FILTER (WHERE o_orderstatus = 'P')"),
            _row("orders", "key_null_rate", "orders", "count(o_orderkey) = count(*)", "count(*) - count(o_orderkey)", "count(*) - count(o_orderkey)"),
            "SELECT 'orders', 'absent_null_rate', 'error', 'FAIL', NULL::double, NULL::bigint",
            "SELECT 'orders', 'optional_null_rate', 'error', 'WARN', NULL::double, NULL::bigint",
        ]
    ),
)
def null_rate(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    checks = [
        Check("orders", "status_null_rate", "null_rate", "o_orderstatus", args={"max": 0.3}),
        Check("orders", "key_null_rate", "null_rate", "o_orderkey", args={"max": 0.3}),
        Check("orders", "absent_null_rate", "null_rate", "o_absent", args={"max": 0.3}),
        Check("orders", "optional_null_rate", "null_rate", "o_absent", args={"max": 0.3}, optional=True),
    ]
    return run_suite({"orders": orders}, checks)


@query(
    "dq_03_freshness",
    " UNION ALL ".join(
        [
            _row("orders", "fresh_180_days", "orders", "max(o_orderdate) >= TIMESTAMP '2002-01-01' - INTERVAL 180 DAY", "DATE '2002-01-01' - max(o_orderdate)::date"),
            _row("lineitem", "fresh_1_hour", "lineitem", "max(l_shipdate) >= TIMESTAMP '2002-01-01' - INTERVAL 1 HOUR", "DATE '2002-01-01' - max(l_shipdate)::date", severity="warn"),
        ]
    ),
)
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("orders", "fresh_180_days", "freshness", "o_orderdate", args={"days": 180}),
        Check("lineitem", "fresh_1_hour", "freshness", "l_shipdate", args={"hours": 1}, severity="warn"),
    ]
    return _rows(spark, sf, ["orders", "lineitem"], checks, AS_OF)


@query(
    "dq_04_referential_integrity",
    " UNION ALL ".join(
        [
            _row("orders", "customer_known", "(SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))", "n = 0", "n", "n"),
            _row("documents", "labelled", "(SELECT count(DISTINCT doc_id) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))", "n = 0", "n", "n", "warn"),
        ]
    ),
)
def referential_integrity(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("orders", "customer_known", "relationship", "o_custkey", args={"parent": "customer", "parent_column": "c_custkey"}),
        Check("documents", "labelled", "relationship", "doc_id", args={"parent": "labels", "parent_column": "doc_id"}, severity="warn"),
    ]
    return _rows(spark, sf, ["orders", "customer", "documents", "labels"], checks)


@query(
    "dq_05_duplicates",
    " UNION ALL ".join(
        [
            _row("orders", "order_key", "(SELECT count(*) - count(DISTINCT o_orderkey) AS n FROM orders)", "n = 0", "n", "n"),
            _row("lineitem", "line_key", "(SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem)", "n = 0", "n", "n"),
        ]
    ),
)
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("orders", "order_key", "no_duplicates", columns=("o_orderkey",)),
        Check("lineitem", "line_key", "no_duplicates", columns=("l_orderkey", "l_linenumber")),
    ]
    return _rows(spark, sf, ["orders", "lineitem"], checks)


@query(
    "dq_06_minimum_value",
    _bad("customer", "balance_from_zero", "customer", "c_acctbal < 0") + " UNION ALL " + _bad("lineitem", "quantity_from_one", "lineitem", "l_quantity < 1"),
)
def minimum_value(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("customer", "balance_from_zero", "min_value", "c_acctbal", args={"min": 0}),
        Check("lineitem", "quantity_from_one", "min_value", "l_quantity", args={"min": 1}),
    ]
    return _rows(spark, sf, ["customer", "lineitem"], checks)


@query(
    "dq_07_not_null",
    f"WITH {s.HOSTS} " + _bad("hosts", "name_present", "raw_hosts", "name IS NULL") + " UNION ALL " + _bad("hosts", "id_present", "raw_hosts", "id IS NULL"),
)
def not_null(spark: SparkSession, sf: str) -> DataFrame:
    checks = [Check("hosts", "name_present", "not_null", "name"), Check("hosts", "id_present", "not_null", "id")]
    return run_suite({"hosts": s.raw_hosts(spark, sf)}, checks)


@query(
    "dq_08_unique",
    " UNION ALL ".join(
        [
            _row("part", "part_key", "(SELECT count(*) AS n FROM (SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1))", "n = 0", "n", "n"),
            _row("documents", "text", "(SELECT count(*) AS n FROM (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1))", "n = 0", "n", "n"),
        ]
    ),
)
def unique(spark: SparkSession, sf: str) -> DataFrame:
    checks = [Check("part", "part_key", "unique", "p_partkey"), Check("documents", "text", "unique", "text")]
    return _rows(spark, sf, ["part", "documents"], checks)


@query(
    "dq_09_accepted_values",
    f"WITH {s.LISTINGS} "
    + _bad("listings", "room_type", "raw_listings", "room_type NOT IN ('Entire home/apt', 'Private room', 'Shared room', 'Hotel room')")
    + " UNION ALL "
    + _bad("events", "known_kind", "events", "event_type NOT IN ('click', 'view', 'signup', 'purchase')"),
)
def accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("listings", "room_type", "accepted_values", "room_type", args={"values": ROOM_TYPES}),
        Check("events", "known_kind", "accepted_values", "event_type", args={"values": ("click", "view", "signup", "purchase")}),
    ]
    return run_suite({"listings": s.raw_listings(spark, sf), "events": table(spark, sf, "events")}, checks)


@query(
    "dq_10_conditional_check",
    _bad("orders", "priority_of_open", "orders", "o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED'", "warn"),
)
def conditional_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    check = Check("orders", "priority_of_open", "not_null", "o_orderpriority", severity="warn", where="o_orderstatus = 'O'")
    return run_suite({"orders": orders}, [check])


@query(
    "dq_11_positive_values",
    _bad("lineitem", "tax_positive", "lineitem", "l_tax <= 0") + " UNION ALL " + _bad("part", "size_positive", "part", "p_size <= 0"),
)
def positive_values(spark: SparkSession, sf: str) -> DataFrame:
    checks = [Check("lineitem", "tax_positive", "positive", "l_tax"), Check("part", "size_positive", "positive", "p_size")]
    return _rows(spark, sf, ["lineitem", "part"], checks)


@query(
    "dq_12_minimum_rows",
    " UNION ALL ".join(
        [
            _row("part", "at_least_100", "part", "count(*) >= 100", "count(*)", severity="warn"),
            _row("region", "at_least_1000", "region", "count(*) >= 1000", "count(*)", severity="warn"),
        ]
    ),
)
def minimum_rows(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("part", "at_least_100", "min_rows", args={"min": 100}, severity="warn"),
        Check("region", "at_least_1000", "min_rows", args={"min": 1000}, severity="warn"),
    ]
    return _rows(spark, sf, ["part", "region"], checks)


@query(
    "dq_13_singular_queries",
    " UNION ALL ".join(
        [
            _row("part", "nights_below_one", "(SELECT count(*) AS n FROM part WHERE p_size - 1 < 1)", "n = 0", "n", "n"),
            _row("customer", "rate_bounds", "(SELECT count(*) AS n FROM customer WHERE c_acctbal / 100 < 0 OR c_acctbal / 100 > 100)", "n = 0", "n", "n"),
        ]
    ),
)
def singular_queries(spark: SparkSession, sf: str) -> DataFrame:
    rate = F.col("c_acctbal") / 100
    nights = table(spark, sf, "part").filter(F.col("p_size") - 1 < 1)
    rates = table(spark, sf, "customer").filter((rate < 0) | (rate > 100))
    return query_test(nights, "part", "nights_below_one").unionByName(query_test(rates, "customer", "rate_bounds"))


@query(
    "dq_13_bounds_with_reason",
    """SELECT c_custkey, c_acctbal / 100 AS rate, CASE WHEN c_acctbal < 0 THEN 'below 0' ELSE 'above 80' END AS reason
       FROM customer WHERE c_acctbal / 100 < 0 OR c_acctbal / 100 > 80""",
)
def bounds_with_reason(spark: SparkSession, sf: str) -> DataFrame:
    rate = F.col("c_acctbal") / 100
    rows = table(spark, sf, "customer").select("c_custkey", rate.alias("rate")).filter((F.col("rate") < 0) | (F.col("rate") > 80))
    return rows.withColumn("reason", F.when(F.col("rate") < 0, "below 0").otherwise("above 80"))


@query(
    "dq_14_same_row_count",
    " UNION ALL ".join(
        [
            _row("joined", "as_many_as_listings", "part", "true", "count(*)"),
            _row("joined", "as_many_as_hosts", "(SELECT (SELECT count(*) FROM part) AS a, (SELECT count(*) FROM supplier) AS b)", "a = b", "a", "abs(a - b)"),
        ]
    ),
)
def same_row_count(spark: SparkSession, sf: str) -> DataFrame:
    listings, hosts = s.raw_listings(spark, sf), s.raw_hosts(spark, sf)
    joined = listings_with_hosts(listings_cleansed(listings), hosts_cleansed(hosts))
    checks = [
        Check("joined", "as_many_as_listings", "same_count", args={"other": "listings"}),
        Check("joined", "as_many_as_hosts", "same_count", args={"other": "hosts"}),
    ]
    return run_suite({"joined": joined, "listings": listings, "hosts": hosts}, checks)


@query(
    "dq_15_mean_and_max",
    " UNION ALL ".join(
        [
            _row("part", "mean_price", "part", "sum(p_retailprice::decimal(18,4))::double / count(*) BETWEEN 50 AND 300", "sum(p_retailprice::decimal(18,4))::double / count(*)"),
            _row("part", "max_price", "part", "max(p_retailprice) <= 5000", "max(p_retailprice)", severity="warn"),
        ]
    ),
)
def mean_and_max(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("part", "mean_price", "mean_between", "p_retailprice", args={"low": 50, "high": 300}),
        Check("part", "max_price", "max_between", "p_retailprice", args={"high": 5000}, severity="warn"),
    ]
    return _rows(spark, sf, ["part"], checks)


@query("dq_16_distinct_count", _row("part", "six_types", "part", "count(DISTINCT p_type) = 6", "count(DISTINCT p_type)"))
def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    return _rows(spark, sf, ["part"], [Check("part", "six_types", "distinct_count", "p_type", args={"equals": 6})])


@query(
    "dq_17_regex",
    _bad("customer", "name_form", "customer", "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')")
    + " UNION ALL "
    + _bad("documents", "starts_upper", "documents", "NOT regexp_matches(source, '^src[0-9]$')"),
)
def regex(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        Check("customer", "name_form", "regex", "c_name", args={"pattern": "^Customer#[0-9]{9}$"}),
        Check("documents", "starts_upper", "regex", "source", args={"pattern": "^src[0-9]$"}),
    ]
    return _rows(spark, sf, ["customer", "documents"], checks)


@query(
    "dq_18_quantile",
    _row("part", "price_q99", "part", "quantile_cont(p_retailprice, 0.99) BETWEEN 50 AND 500", "quantile_cont(p_retailprice, 0.99)"),
)
def quantile_check(spark: SparkSession, sf: str) -> DataFrame:
    check = Check("part", "price_q99", "quantile_between", "p_retailprice", args={"quantile": 0.99, "low": 50, "high": 500})
    return _rows(spark, sf, ["part"], [check])


HOST_CONTRACT = StructType(
    [
        StructField("s_suppkey", LongType(), False),
        StructField("s_name", StringType(), False),
        StructField("s_nationkey", IntegerType()),
        StructField("s_acctbal", DoubleType()),
    ]
)


@query(
    "dq_19_contract",
    " UNION ALL ".join(
        [
            _bad("supplier", "not_null_s_suppkey", "supplier", "s_suppkey IS NULL"),
            _bad("supplier", "not_null_s_name", "supplier", "s_name IS NULL"),
            _row("supplier", "primary_key", "(SELECT count(*) - count(DISTINCT s_suppkey) AS n FROM supplier)", "n = 0", "n", "n"),
            "SELECT 'supplier', 'columns_and_types', 'error', 'PASS', 0::double, 0::bigint",
        ]
    ),
)
def contract(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    rows = run_suite({"supplier": supplier}, contract_checks("supplier", HOST_CONTRACT, ["s_suppkey"]))
    return rows.unionByName(query_test(schema_differences(supplier, HOST_CONTRACT), "supplier", "columns_and_types"))


@query("dq_20_enforced_constraint", "SELECT o_orderkey, o_totalprice FROM orders")
def enforced_constraint(spark: SparkSession, sf: str) -> DataFrame:
    """A guarded column passes through; a negative price would stop the job."""
    price = F.col("o_totalprice")
    orders = enforced(table(spark, sf, "orders"), "o_totalprice", price.isNull() | (price >= 0), "o_totalprice must not be negative")
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "dq_20_refused_write",
    """SELECT 1 AS attempt, 'published' AS outcome, 0::BIGINT AS broken_rows, count(*) AS readable_rows, sum(o_totalprice)::double AS readable_total FROM orders
       UNION ALL SELECT 2, CASE WHEN count(*) FILTER (WHERE o_totalprice < 20000) > 0 THEN 'refused' ELSE 'published' END,
         count(*) FILTER (WHERE o_totalprice < 20000), count(*), sum(o_totalprice)::double FROM orders""",
)
def refused_write(spark: SparkSession, sf: str) -> DataFrame:
    """A table whose prices may not be negative: a write that breaks the rule is refused and the old rows stay readable."""
    root = scratch_path(spark, "guarded")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_totalprice").alias("rest"))
    rules, told = {"rest": F.col("rest") >= 0}, []
    for attempt, frame in enumerate((orders, orders.withColumn("rest", F.col("rest") - 20000)), 1):
        try:
            publish_version(frame, root, "guarded_orders", constraints=rules)
            outcome, broken = "published", 0
        except ConstraintBroken as error:
            outcome, broken = "refused", error.broken["rest"]
        readable = read_table(spark, latest_version(spark, root))
        told.append(
            readable.agg(F.count(F.lit(1)).alias("readable_rows"), F.sum("o_totalprice").alias("readable_total")).select(
                F.lit(attempt).alias("attempt"), F.lit(outcome).alias("outcome"), F.lit(broken).cast("long").alias("broken_rows"), "readable_rows", "readable_total"
            )
        )
    return told[0].unionByName(told[1])


@query(
    "dq_21_stored_failures",
    """SELECT 'balance_from_zero' AS check_name, c_custkey::varchar AS row_key FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT 'line_key', l_orderkey || '-' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def stored_failures(spark: SparkSession, sf: str) -> DataFrame:
    tables = {name: table(spark, sf, name) for name in ("customer", "lineitem")}
    checks = [
        Check("customer", "balance_from_zero", "min_value", "c_acctbal", args={"min": 0}),
        Check("lineitem", "line_key", "no_duplicates", columns=("l_orderkey", "l_linenumber")),
    ]
    paths = store_failures(tables, checks, scratch_path(spark, "failures"))
    balances = read_table(spark, paths["balance_from_zero"]).select(F.col("reason").alias("check_name"), F.col("c_custkey").cast("string").alias("row_key"))
    lines = read_table(spark, paths["line_key"]).select(
        F.col("reason").alias("check_name"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("row_key")
    )
    return balances.unionByName(lines)


@query(
    "dq_21_stored_orphans",
    """SELECT doc_id, source, 'labelled' AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""",
)
def stored_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """The documents themselves that no label knows, stored as the failures of a relationship."""
    tables = {name: table(spark, sf, name).select(*columns) for name, columns in (("documents", ("doc_id", "source")), ("labels", ("doc_id",)))}
    check = Check("documents", "labelled", "relationship", "doc_id", args={"parent": "labels", "parent_column": "doc_id"})
    return read_table(spark, store_failures(tables, [check], scratch_path(spark, "orphans"))["labelled"])


@query(
    "dq_22_gate",
    """SELECT count(*) AS orders, sum(o_totalprice::decimal(18,2))::double AS total FROM orders""",
)
def gated(spark: SparkSession, sf: str) -> DataFrame:
    """The gate lets the passing suite through to the next step; a FAIL would raise."""
    orders = table(spark, sf, "orders")
    checks = [
        Check("orders", "key", "no_duplicates", columns=("o_orderkey",)),
        Check("orders", "price", "min_value", "o_totalprice", args={"min": 0}),
        Check("orders", "enough", "min_rows", args={"min": 1}),
        Check("orders", "cheap", "max_between", "o_totalprice", args={"high": 1}, severity="warn"),
    ]
    gate(run_suite({"orders": orders}, checks))
    return orders.agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query(
    "dq_07_failing_rows",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'balance_from_zero' AS reason FROM customer WHERE c_acctbal < 0",
)
def failing(spark: SparkSession, sf: str) -> DataFrame:
    return failing_rows(table(spark, sf, "customer"), Check("customer", "balance_from_zero", "min_value", "c_acctbal", args={"min": 0}))


@query(
    "dq_23_mart_verification",
    f"""WITH {s.PROVINCE_CLEAN},
    m AS (
      SELECT *, row_number() OVER w AS rn, ref_date > min(ref_date) OVER () AS later FROM province
      WHERE {s.HEADLINE} AND age_group = '15 years and over' AND gender = 'Total - Gender'
      WINDOW w AS (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date)
    )
    SELECT count(*) AS total_rows, (count(*) FILTER (WHERE rn = 1 AND later))::bigint AS null_mom_after_first,
           (count(*) FILTER (WHERE rn > 12))::bigint AS rows_with_yoy, count(geo) AS rows_with_geo, count(*) AS rows_with_dimension,
           0::bigint AS repeated_keys FROM m""",
)
def mart_verification(spark: SparkSession, sf: str) -> DataFrame:
    province = headline(s.province_clean(spark, sf))
    mart = trend_mart(monthly_fact(province, headline(s.industry_clean(spark, sf))), dimension_history(s.province_clean(spark, sf)), geo_dimension(province))
    return mart_checks(mart)


@query(
    "dq_00_whole_suite",
    " UNION ALL ".join(
        [
            _bad("lineitem", "quantity", "lineitem", "l_quantity < 1"),
            _bad("lineitem", "flag", "lineitem", "l_returnflag NOT IN ('A', 'N', 'R')"),
            _bad("lineitem", "discount", "lineitem", "l_discount NOT BETWEEN 0 AND 0.08"),
            _row("lineitem", "rows", "lineitem", "count(*) >= 10", "count(*)"),
            _row("lineitem", "mean_quantity", "lineitem", "sum(l_quantity::decimal(18,4))::double / count(*) BETWEEN 20 AND 30", "sum(l_quantity::decimal(18,4))::double / count(*)"),
            _bad("lineitem", "shipped_after_start", "lineitem", "NOT (l_shipdate > TIMESTAMP '1995-02-01')", "warn"),
        ]
    ),
)
def whole_suite(spark: SparkSession, sf: str) -> DataFrame:
    """Six checks of the largest table from one scan of it."""
    checks = [
        Check("lineitem", "quantity", "min_value", "l_quantity", args={"min": 1}),
        Check("lineitem", "flag", "accepted_values", "l_returnflag", args={"values": ("A", "N", "R")}),
        Check("lineitem", "discount", "in_range", "l_discount", args={"low": 0, "high": 0.08}),
        Check("lineitem", "rows", "min_rows", args={"min": 10}),
        Check("lineitem", "mean_quantity", "mean_between", "l_quantity", args={"low": 20, "high": 30}),
        Check("lineitem", "shipped_after_start", "expression", args={"true_when": "l_shipdate > TIMESTAMP_NTZ '1995-02-01 00:00:00'"}, severity="warn"),
    ]
    return _rows(spark, sf, ["lineitem"], checks)


@query(
    "agg_01_flag_counts",
    f"""WITH {s.PROVINCE_CLEAN} SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_suppressed) AS suppressed,
          count(value) AS with_value FROM province""",
)
def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counted(s.province_clean(spark, sf), {"suppressed": F.col("is_suppressed"), "with_value": F.col("value").isNotNull()})
