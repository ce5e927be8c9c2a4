"""Table writers. Only these functions (and the quality gate) start jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakewright.session import stored
from lakewright.sources.files import read_table, table_exists


class WriteMismatch(RuntimeError):
    """A table read back does not hold what was written."""


class SchemaMismatch(RuntimeError):
    """A frame does not have the columns its target has."""


def same_columns(left: StructType, right: StructType) -> bool:
    """Equal names and types; order and nullability do not matter."""
    return {f.name: f.dataType for f in left} == {f.name: f.dataType for f in right}


def _refuse_other_columns(df: DataFrame, existing: StructType, path: str, partition_by: Sequence[str]) -> None:
    def compared(schema: StructType) -> StructType:
        return StructType([f for f in schema if f.name not in partition_by])

    if set(existing.names) != set(df.columns) or not same_columns(compared(existing), compared(df.schema)):
        raise SchemaMismatch(f"{path} has {existing.simpleString()}, frame has {df.schema.simpleString()}")


def _writer(df: DataFrame, partition_by: Sequence[str], max_rows_per_file: int | None, rebalance: bool = True):
    # rebalancing brings each partition's rows together and AQE splits the big ones,
    # so the table gets neither one file per task and partition nor one giant task
    writer = (df.hint("rebalance", *partition_by) if partition_by and rebalance else df).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    return writer


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    evolve: bool = False,
    max_rows_per_file: int | None = None,
    rebalance: bool = True,
) -> None:
    """Replace a whole table. Other columns or types are refused unless ``evolve``.

    The types of partition columns are read from folder names and not compared.

    ``rebalance=False`` saves the shuffle where a task's rows fall into few
    partitions anyway, as when one load is written under its load date.
    """
    spark = df.sparkSession
    if not evolve and table_exists(spark, path):
        _refuse_other_columns(df, read_table(spark, path).schema, path, partition_by)
    writer = _writer(df, partition_by, max_rows_per_file, rebalance)
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions the frame has rows for."""
    writer = _writer(df, partition_by, None)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def compact_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], where: Column) -> None:
    """Rewrite the partitions that ``where`` names with few files. Not while another job writes to them.

    The rows are stored in the scratch folder first, so they are not read from what is replaced.
    """
    overwrite_partitions(stored(read_table(spark, path).filter(where), "compaction"), path, partition_by)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, or start it. Other columns or types are refused."""
    if table_exists(df.sparkSession, path):
        _refuse_other_columns(df, read_table(df.sparkSession, path).schema, path, partition_by)
    _writer(df, partition_by, None).mode("append").parquet(path)


def write_verified(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), evolve: bool = False, rebalance: bool = True
) -> int:
    """Overwrite, count the rows on their way out, compare with the table read back.

    The written count is observed inside the write job and the read-back count
    comes from file footers, so the frame is evaluated once.
    """
    spark = df.sparkSession
    seen = Observation()
    overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by, evolve, rebalance=rebalance)
    written, there = seen.get["rows"], read_table(spark, path).count()
    if written != there:
        raise WriteMismatch(f"{path}: wrote {written} rows, read back {there}")
    return there


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
    replace: bool = False,
) -> DataFrame:
    """Catalog entry over an existing folder, created if absent or replaced.

    A partitioned table needs its schema, and its partitions are found on disk.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) if schema else ""
    declared = f"({columns})" if columns else ""
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {declared} USING parquet {partitions} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


class ConstraintBroken(RuntimeError):
    """A frame breaks rules of the table it was written for; ``broken`` has the rows per rule."""

    def __init__(self, path: str, broken: Mapping[str, int]):
        super().__init__(f"{path}: " + ", ".join(f"{n} rows break '{rule}'" for rule, n in sorted(broken.items())))
        self.broken = dict(broken)


PUBLISHED = "_published"


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in fs.listStatus(path)] if fs.exists(path) else []


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest published version under a root, if there is one."""
    found = _names(spark, f"{root}/{PUBLISHED}")
    return f"{root}/{max(found)}" if found else None


def write_version(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), constraints: Mapping[str, Column] | None = None, rebalance: bool = True
) -> str:
    """Write the next version folder of a table, which no reader sees before ``publish``; gives its path.

    ``constraints`` are rules by name that every row has to meet (unknown passes). Their
    violations and the rows are counted inside the write job; a broken rule or a row that
    is not there afterwards raises, and the published version stays what it was.
    """
    spark, rules = df.sparkSession, dict(constraints or {})
    numbers = [int(name.split("-")[1]) for name in _names(spark, root) if name.startswith("version-")]
    path = f"{root}/version-{max(numbers, default=0) + 1:012d}"
    seen = Observation()
    counts = [F.count_if(~F.coalesce(rule, F.lit(True))).alias(f"broken {name}") for name, rule in rules.items()]
    overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), path, partition_by, rebalance=rebalance)
    told = seen.get
    broken = {name: told[f"broken {name}"] for name in rules if told[f"broken {name}"]}
    if broken:
        raise ConstraintBroken(path, broken)
    there = read_table(spark, path, df.schema).count()
    if there != told["rows"]:
        raise WriteMismatch(f"{path}: wrote {told['rows']} rows, read back {there}")
    return path


def publish(spark: SparkSession, path: str, view: str | None = None) -> str:
    """Make a version the newest one of its table, by one empty file named after it, and point a view at it."""
    root, name = path.rsplit("/", 1)
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{PUBLISHED}/{name}")
    fs = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.createNewFile(marker):
        raise WriteMismatch(f"{path} is published already")
    if view:
        read_table(spark, path).createOrReplaceTempView(view)
    return path


def publish_version(
    df: DataFrame, root: str, view: str, partition_by: Sequence[str] = (), constraints: Mapping[str, Column] | None = None
) -> str:
    """Write a new version, then publish it.

    Readers keep the old version until the new one is complete and meets the rules, so a
    frame may be computed from the table it replaces, and a failed write changes nothing.
    """
    return publish(df.sparkSession, write_version(df, root, partition_by, constraints), view)


def materialize(
    df: DataFrame,
    name: str,
    mode: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Turn a model into a ``view``, ``table``, ``ephemeral`` or ``incremental`` result.

    ``incremental`` writes the whole frame on the first run and appends
    ``merge(target, df)`` afterwards.
    """
    spark = df.sparkSession
    if mode == "ephemeral":
        return df
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path is None:
        raise ValueError(f"mode '{mode}' needs a path")
    if mode == "table":
        overwrite_table(df, path, partition_by, evolve=True)
        return register_table(spark, name, path, df.schema, partition_by, replace=True)
    if mode == "incremental":
        if not table_exists(spark, path):
            overwrite_table(df, path, partition_by)
        else:
            append_table(merge(read_table(spark, path), df) if merge else df, path, partition_by)
        return read_table(spark, path)
    raise ValueError(f"unknown materialisation '{mode}'")


def audit_rows(spark: SparkSession, runs: Mapping[str, datetime]) -> DataFrame:
    """One row per finished model: its name and run time."""
    return spark.createDataFrame(list(runs.items()), "model_name string, run_time timestamp")


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory, spilling to disk, for the length of a block."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
