"""Runs registered queries against their SQL twins: ``python tests/oracle_compare.py [sf_dir] [name part ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if os.environ.get("EXACT") else float(f"{value:.10g}") + 0.0
    return value


def _sorted_rows(rows: list[tuple], order: list[int]) -> list[tuple]:
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a frame and a query; empty when they agree."""
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    ours_types = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if ours_types != theirs_types:
        wrong = {n for n in ours_types.keys() | theirs_types.keys() if ours_types.get(n) != theirs_types.get(n)}
        found.append("columns: " + ", ".join(f"{n} {ours_types.get(n)} / {theirs_types.get(n)}" for n in sorted(wrong)))
    if ours_types.keys() != theirs_types.keys():
        return found
    ours = [tuple(row) for row in df.collect()]
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} / {len(theirs)}")
    names = sorted(ours_types)
    a = _sorted_rows(ours, [df.columns.index(n) for n in names])
    b = _sorted_rows(theirs, [list(theirs_types).index(n) for n in names])
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if unequal:
        found.append(f"values: {len(unequal)} rows differ in order, first {names}\n      {unequal[0][0]}\n      {unequal[0][1]}")
    return found


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    from lakewright.catalog import ENTRIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    parts = argv[1:]
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name, entry in ENTRIES.items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            found = differences(entry.run(spark, sf_dir), con, entry.sql) if entry.sql else []
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - started:.2f}s", flush=True)
        for line in found:
            print("    ", line, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
