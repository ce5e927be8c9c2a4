"""Data-quality checks whose results are rows, and the gate that reads them.

A suite compiles to one aggregation per table for all checks that look at rows
or whole-column aggregates, plus one small plan for each check that has to group
or join. Nothing is collected until ``gate``, but a quantile check stores and sizes its
values while the suite is built.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewright.functions.dates import moment
from lakewright.operators.aggregates import conjunction, repeated_keys, rows_per_key
from lakewright.operators.joins import orphan_rows, orphans
from lakewright.operators.ranks import exact_quantile
from lakewright.sinks.tables import overwrite_table

RESULT_COLUMNS = ("table_name", "check_name", "severity", "status", "observed", "failing_rows")


class DataQualityError(RuntimeError):
    """The gate found failed checks."""


@dataclass(frozen=True)
class Check:
    """One check of one table.

    ``kind`` names the rule, ``column`` (or ``columns``) what it looks at and
    ``args`` its limits. ``where`` filters the rows first. A failing check is
    FAIL or, with severity ``warn``, WARN. A missing column fails, or warns when
    ``optional``.
    """

    table: str
    name: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    args: Mapping[str, object] = field(default_factory=dict)
    severity: str = "error"
    where: str | None = None
    optional: bool = False

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.column, *self.columns) if self.column else self.columns


def _within(value: Column, low: object, high: object) -> Column:
    sides = []
    if low is not None:
        sides.append(value >= F.lit(low))
    if high is not None:
        sides.append(value <= F.lit(high))
    return F.coalesce(conjunction(sides), F.lit(False))


# Rules about single rows: the condition a bad row meets.
ROW_RULES: dict[str, Callable[[Check], Column]] = {
    "not_null": lambda c: F.col(c.column).isNull(),
    "accepted_values": lambda c: ~F.col(c.column).isin(*c.args["values"]),
    "min_value": lambda c: F.col(c.column) < F.lit(c.args["min"]),
    "positive": lambda c: F.col(c.column) <= 0,
    "regex": lambda c: ~F.col(c.column).rlike(c.args["pattern"]),
    "in_range": lambda c: ~F.col(c.column).between(c.args.get("low"), c.args.get("high")),
    "expression": lambda c: ~F.expr(str(c.args["true_when"])),
}


def bad_rows(check: Check) -> Column:
    """Condition of a failing row; an unknown condition is not a failure."""
    return F.coalesce(ROW_RULES[check.kind](check), F.lit(False))


def failing_rows(df: DataFrame, check: Check, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows that break a row rule, with the reason. A relationship needs ``tables`` for its parent."""
    rows = df.filter(check.where) if check.where else df
    if check.kind in ROW_RULES:
        return rows.filter(bad_rows(check)).withColumn("reason", F.lit(check.name))
    if check.kind in ("unique", "no_duplicates"):
        keys = list(check.needs)
        # NULL keys repeat one another in a primary key, but not under a unique rule
        return repeated_keys(rows.na.drop(subset=keys) if check.kind == "unique" else rows, keys).withColumn("reason", F.lit(check.name))
    if check.kind == "relationship" and tables:
        parent = tables[str(check.args["parent"])]
        return orphan_rows(rows, check.column, parent, str(check.args["parent_column"])).withColumn("reason", F.lit(check.name))
    raise ValueError(f"'{check.kind}' does not judge single rows")


def _freshness(check: Check, as_of: datetime) -> tuple[Column, Column]:
    newest = F.max(check.column).cast("timestamp")
    limit = moment(as_of) - F.make_dt_interval(
        days=F.lit(int(check.args.get("days", 0))), hours=F.lit(int(check.args.get("hours", 0)))
    )
    age_days = F.datediff(moment(as_of).cast("date"), newest.cast("date"))
    return age_days.cast("double"), F.coalesce(newest >= limit, F.lit(False))


def _column_rules(check: Check, keep: Column, as_of: datetime | None) -> tuple[Column, Column, Column]:
    """(observed, passed, failing rows) of a check that is one aggregate expression."""
    kind, args = check.kind, check.args
    none = F.lit(0).cast("bigint")
    if kind in ROW_RULES:
        bad = F.count_if(keep & bad_rows(check))
        return bad.cast("double"), bad == 0, bad
    if kind == "null_rate":
        total, nulls = F.count_if(keep), F.count_if(keep & F.col(check.column).isNull())
        rate = F.try_divide(nulls.cast("double"), total.cast("double"))
        return rate, F.coalesce(rate <= F.lit(float(args["max"])), F.lit(False)), nulls
    if kind == "min_rows":
        total = F.count_if(keep)
        return total.cast("double"), total >= F.lit(args["min"]), none
    value = F.when(keep, F.col(check.column)) if check.column else None
    if kind == "mean_between":
        mean = F.avg(value).cast("double")
        return mean, _within(mean, args.get("low"), args.get("high")), none
    if kind == "max_between":
        top = F.max(value).cast("double")
        return top, _within(top, args.get("low"), args.get("high")), none
    if kind == "freshness":
        if as_of is None:
            raise ValueError(f"'{check.name}' needs as_of")
        age, fresh = _freshness(check, as_of)
        return age, fresh, none
    raise ValueError(f"unknown check '{kind}'")


GROUPED = ("unique", "no_duplicates", "relationship", "distinct_count", "quantile_between", "same_count", "at_least_count")


def _grouped(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """One-row frame (observed, passed, failing) of a check that groups or joins."""
    df = tables[check.table]
    df = df.filter(check.where) if check.where else df
    args, none = check.args, F.lit(0).cast("bigint")
    if check.kind == "unique":
        n = F.count(F.lit(1))
        return rows_per_key(df.na.drop(subset=list(check.needs)), check.needs).filter("_n > 1").agg(
            n.cast("double").alias("observed"), (n == 0).alias("passed"), n.alias("failing")
        )
    if check.kind == "no_duplicates":
        extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
        return rows_per_key(df, check.needs).agg(extra.cast("double").alias("observed"), (extra == 0).alias("passed"), extra.alias("failing"))
    if check.kind == "relationship":
        n = F.count(F.lit(1))
        return orphans(df, check.column, tables[args["parent"]], args["parent_column"]).agg(
            n.cast("double").alias("observed"), (n == 0).alias("passed"), n.alias("failing")
        )
    if check.kind == "distinct_count":
        n = F.count(F.lit(1))
        return df.select(check.column).na.drop().distinct().agg(
            n.cast("double").alias("observed"), (n == F.lit(args["equals"])).alias("passed"), none.alias("failing")
        )
    if check.kind == "quantile_between":
        q = F.col("q")
        return exact_quantile(df, check.column, args["quantile"], "q").select(
            q.cast("double").alias("observed"),
            _within(q, args.get("low"), args.get("high")).alias("passed"),
            none.alias("failing"),
        )
    other = tables[args["other"]]
    if args.get("distinct_on"):
        other = other.select(*args["distinct_on"]).distinct()
    there = other.agg(F.count(F.lit(1)).alias("n")).scalar()
    here = F.count(F.lit(1))
    passed = here == F.max(there) if check.kind == "same_count" else here >= F.max(there)
    missing = F.max(there) - here
    failing = F.abs(missing) if check.kind == "same_count" else F.greatest(missing, none)
    return df.agg(here.cast("double").alias("observed"), passed.alias("passed"), failing.alias("failing"))


def _status(check: Check, passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("WARN" if check.severity == "warn" else "FAIL"))


def _result(check: Check, observed: Column, passed: Column, failing: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        _status(check, passed).alias("status"),
        observed.cast("double").alias("observed"),
        failing.cast("bigint").alias("failing_rows"),
    )


def _missing(tables: Mapping[str, DataFrame], check: Check) -> bool:
    return any(name not in tables[check.table].columns for name in check.needs)


def _table_results(df: DataFrame, checks: Sequence[Check], as_of: datetime | None) -> DataFrame:
    """All aggregate checks of one table from one scan."""
    parts, rows = [], []
    for i, check in enumerate(checks):
        keep = F.coalesce(F.expr(check.where), F.lit(False)) if check.where else F.lit(True)
        observed, passed, failing = _column_rules(check, keep, as_of)
        parts += [
            observed.cast("double").alias(f"_o{i}"),
            passed.alias(f"_p{i}"),
            failing.cast("bigint").alias(f"_f{i}"),
        ]
        rows.append(_result(check, F.col(f"_o{i}"), F.col(f"_p{i}"), F.col(f"_f{i}")))
    return df.agg(*parts).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of: datetime | None = None) -> DataFrame:
    """One result row per check."""
    frames: list[DataFrame] = []
    spark = next(iter(tables.values())).sparkSession
    absent = [c for c in checks if _missing(tables, c)]
    if absent:
        frames.append(
            spark.createDataFrame(
                [(c.table, c.name, c.severity, "WARN" if c.optional else "FAIL", None, None) for c in absent],
                "table_name string, check_name string, severity string, status string, observed double, failing_rows bigint",
            )
        )
    present = [c for c in checks if c not in absent]
    for table in dict.fromkeys(c.table for c in present):
        scalar = [c for c in present if c.table == table and c.kind not in GROUPED]
        if scalar:
            frames.append(_table_results(tables[table], scalar, as_of))
    for check in present:
        if check.kind in GROUPED:
            one = _grouped(tables, check)
            frames.append(
                one.select(_result(check, F.col("observed"), F.col("passed"), F.col("failing")).alias("_r")).select("_r.*")
            )
    results = frames[0]
    for frame in frames[1:]:
        results = results.unionByName(frame)
    return results.select(*RESULT_COLUMNS)


def gate(results: DataFrame) -> list[dict[str, object]]:
    """Collect the results (one row per check) and stop on any FAIL."""
    rows = [row.asDict() for row in results.collect()]
    failed = [f"{r['table_name']}.{r['check_name']} (observed {r['observed']})" for r in rows if r["status"] == "FAIL"]
    if failed:
        raise DataQualityError(f"{len(failed)} of {len(rows)} checks failed: " + "; ".join(sorted(failed)))
    return rows


def query_test(rows: DataFrame, table: str, name: str, severity: str = "error") -> DataFrame:
    """A frame that should be empty, as a result row."""
    check = Check(table, name, "query", severity=severity)
    n = F.count(F.lit(1))
    return (
        rows.agg(n.alias("_n"))
        .select(_result(check, F.col("_n"), F.col("_n") == 0, F.col("_n")).alias("_r"))
        .select("_r.*")
    )


def store_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check], root: str) -> dict[str, str]:
    """Write the failing rows of each check to its own folder."""
    paths = {}
    for check in checks:
        paths[check.name] = f"{root}/{check.table}/{check.name}"
        overwrite_table(failing_rows(tables[check.table], check, tables), paths[check.name], evolve=True)
    return paths


def schema_differences(df: DataFrame, contract: StructType) -> DataFrame:
    """One row per column that is missing, extra or of another type; empty when the contract holds."""
    declared = {f.name: f.dataType.simpleString() for f in contract}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [
        (name, declared.get(name), actual.get(name))
        for name in sorted(declared.keys() | actual.keys())
        if declared.get(name) != actual.get(name)
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, declared string, actual string")


def contract_checks(table: str, contract: StructType, primary_key: Sequence[str]) -> list[Check]:
    """Not-null and primary-key checks of a declared schema."""
    checks = [Check(table, f"not_null_{f.name}", "not_null", f.name) for f in contract if not f.nullable]
    return [*checks, Check(table, "primary_key", "no_duplicates", columns=tuple(primary_key))]


def enforced(df: DataFrame, column: str, rule: Column, message: str) -> DataFrame:
    """Guard a column: a row that breaks the rule stops the job that reads it. Unknown passes."""
    broken = ~F.coalesce(rule, F.lit(True))
    return df.withColumn(
        column,
        F.when(broken, F.raise_error(F.lit(message)).cast(df.schema[column].dataType)).otherwise(F.col(column)),
    )
