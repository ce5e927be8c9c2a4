"""Contracts, gates and guards."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakewright.operators.filters import split_valid
from lakewright.operators.incremental import batch_ranges, new_since
from lakewright.operators.projections import ContractError, drop_present, rename_contract, sanitize_names
from lakewright.operators.quality import Check, DataQualityError, contract_checks, enforced, gate, run_suite, schema_differences
from lakewright.operators.windows import keep_latest
from lakewright.sinks.tables import SchemaMismatch, append_table, materialize, overwrite_table, write_verified
from lakewright.sources.files import read_raw_csv, read_table, table_exists
from lakewright.sources.names import Sources
from lakewright.sources.relational import overwrite_jdbc, read_jdbc
from lakewright.sources.seeds import full_moons


def test_rename_lists_missing(spark):
    with pytest.raises(ContractError, match="missing columns \\['b'\\]"):
        rename_contract(spark.range(1), {"id": "a", "b": "c"})


def test_colliding_names(spark):
    with pytest.raises(ContractError, match="a_b"):
        sanitize_names(spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("a-b")))


def test_drop_present(spark):
    assert drop_present(spark.range(1).withColumn("x", F.lit(1)), ["x", "y"]).columns == ["id"]


def test_keep_latest_needs_tie_breakers(spark):
    with pytest.raises(ValueError):
        keep_latest(spark.range(1), ["id"], "id", [])


def test_unknown_conditions_are_rejected(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    valid, rejects = split_valid(df, {"positive": F.col("v") > 0})
    assert valid.count() == 1
    assert sorted(r["_reject_reason"] for r in rejects.collect()) == ["positive", "positive"]


def test_schema_change_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(3), path)
    with pytest.raises(SchemaMismatch):
        overwrite_table(spark.range(3).withColumn("x", F.lit(1)), path)
    overwrite_table(spark.range(3).withColumn("x", F.lit(1)), path, evolve=True)
    assert read_table(spark, path).columns == ["id", "x"]
    with pytest.raises(SchemaMismatch):
        new_since(spark.range(3), read_table(spark, path), "id")


def test_verified_write_and_existence(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    assert write_verified(spark.range(5), path) == 5
    assert table_exists(spark, path)


def test_materialize_modes(spark, tmp_path):
    df = spark.range(2)
    with pytest.raises(ValueError):
        materialize(df, "m", "table")
    with pytest.raises(ValueError):
        materialize(df, "m", "other", str(tmp_path / "m"))
    path = str(tmp_path / "inc")
    assert materialize(df, "m", "incremental", path).count() == 2
    assert materialize(df, "m", "incremental", path).count() == 4


def test_gate_stops_on_fail_only(spark):
    tables = {"t": spark.range(3)}
    warn = Check("t", "enough", "min_rows", args={"min": 10}, severity="warn")
    assert gate(run_suite(tables, [warn]))[0]["status"] == "WARN"
    with pytest.raises(DataQualityError, match="t.enough"):
        gate(run_suite(tables, [Check("t", "enough", "min_rows", args={"min": 10})]))


def test_empty_table_fails_null_rate(spark):
    rows = run_suite({"t": spark.range(0)}, [Check("t", "n", "null_rate", "id", args={"max": 0.5})]).collect()
    assert rows[0]["status"] == "FAIL"


def test_all_null_time_is_not_fresh(spark):
    df = spark.createDataFrame([(None,)], "d date")
    rows = run_suite({"t": df}, [Check("t", "f", "freshness", "d", args={"days": 1})], datetime(2026, 1, 1)).collect()
    assert rows[0]["status"] == "FAIL"


def test_rate_bounds(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (100.0,), (101.0,), (None,)], "r double")
    rows = run_suite({"t": df}, [Check("t", "rate", "in_range", "r", args={"low": 0, "high": 100})]).collect()
    assert (rows[0]["status"], rows[0]["failing_rows"]) == ("FAIL", 2)


def test_contract(spark):
    contract = StructType([StructField("id", LongType(), False), StructField("name", StringType())])
    found = {r["column_name"]: (r["declared"], r["actual"]) for r in schema_differences(spark.range(1), contract).collect()}
    assert found == {"name": ("string", None)}
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id bigint, name string")
    status = {r["check_name"]: r["status"] for r in run_suite({"t": df}, contract_checks("t", contract, ["id"])).collect()}
    assert status == {"not_null_id": "FAIL", "primary_key": "FAIL"}


def test_enforced_constraint(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert enforced(df, "v", F.col("v") >= 0, "negative").count() == 2
    with pytest.raises(Exception, match="negative value"):
        enforced(df, "v", F.col("v") >= 5, "negative value").collect()


def test_undeclared_source(spark):
    with pytest.raises(KeyError, match="not declared"):
        Sources(spark, {"a": "b"}).get("c")


def test_csv_with_byte_order_mark(spark, tmp_path):
    file = tmp_path / "f.csv"
    file.write_bytes("﻿REF_DATE,VALUE\n1976-01,\n1976-02,5\n".encode())
    df = read_raw_csv(spark, str(file))
    assert df.columns == ["REF_DATE", "VALUE"]
    assert [tuple(r) for r in df.collect()] == [("1976-01", None), ("1976-02", "5")]


def test_append_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(spark.range(2), path)
    append_table(spark.range(3), path)
    assert read_table(spark, path).count() == 5


def test_batch_ranges():
    assert batch_ranges(date(2009, 6, 20), date(2011, 1, 1)) == [
        (date(2009, 6, 20), date(2010, 1, 1)),
        (date(2010, 1, 1), date(2011, 1, 1)),
        (date(2011, 1, 1), date(2012, 1, 1)),
    ]
    assert batch_ranges(date(2009, 12, 31), date(2010, 1, 1), "month")[-1] == (date(2010, 1, 1), date(2010, 2, 1))
    assert len(batch_ranges(date(2026, 1, 1), date(2026, 1, 3), "day")) == 3
    with pytest.raises(ValueError):
        batch_ranges(date(2026, 1, 1), date(2026, 1, 3), "week")


def test_full_moons_span(spark):
    days = [r[0] for r in full_moons(spark, date(1999, 1, 1), date(2000, 12, 31)).orderBy(F.col("full_moon_date")).collect()]
    gaps = {(b - a).days for a, b in zip(days, days[1:])}
    assert len(days) in (24, 25) and gaps <= {29, 30}
    assert all(date(1999, 1, 1) <= d <= date(2000, 12, 31) for d in days)


class _Recorder:
    """Stands for a reader or writer: keeps what it is told, so no database is needed."""

    def __init__(self):
        self.calls, self.done = {}, None

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def load(self):
        return self.calls

    def jdbc(self, url, table, mode, properties):
        self.done = (url, table, mode, properties)


def test_relational_options():
    class Session:
        read = _Recorder()

    class Frame:
        write = _Recorder()

    options = read_jdbc(Session(), "jdbc:x:y", "features", "user_id", (0, 100), 4, {"driver": "d"})
    assert options["numPartitions"] == 4 and options["lowerBound"] == "0" and options["driver"] == "d"
    with pytest.raises(ValueError):
        read_jdbc(Session(), "jdbc:x:y", "features", "user_id")
    overwrite_jdbc(Frame(), "jdbc:x:y", "features", properties={"user": "u"})
    assert Frame.write.calls["truncate"] is True
    assert Frame.write.done == ("jdbc:x:y", "features", "overwrite", {"user": "u"})
