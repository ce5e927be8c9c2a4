"""Table access and stored intermediate results of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.session import scratch_path

#: Bitmaps of 32,768 ids (4 KB) each up to which ids are broadcast: 32 MB.
BITMAPS = 8192
#: Session setting of the rows that go to Python at once.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be no name of ``columns`` (in any case)."""
    taken, free = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside hand at most ``rows`` rows at once to Python, or fewer if the session says so; its setting is put back.

    A batch is held as a whole by the executor and by the worker. Results do not depend on it.
    """
    before = spark.conf.get(BATCH_SETTING)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH_SETTING, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def settled(df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back; with ``batch``, at most so many rows go to Python at once.

    Cuts the lineage, so a lost executor repeats no more than the jobs that follow,
    and gives the planner the true size of what it may broadcast.
    """
    path = scratch_path(df.sparkSession, label)
    with batches_of(df.sparkSession, batch) if batch else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_with(df: DataFrame, ids: DataFrame, id: str, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose whole-number ``id`` is among those of ``ids`` (or is not); a null is equal to a null.

    The ids are broadcast as bitmaps, an eighth of a byte for each if they are dense, so
    wide rows are not moved. Ids that lie far apart would take a bitmap each; beyond
    ``BITMAPS`` the rows are joined as usual.
    """
    bucket, own, bits = unused(df.columns, "_bucket", "_id", "_bits")
    wanted = ids.select(F.col(id).cast("long").alias(own))
    number, place = (F.expr(f"{f}(`{own}`)") for f in ("bitmap_bucket_number", "bitmap_bit_position"))
    told = settled(wanted.groupBy(number.alias(bucket)).agg(F.bitmap_construct_agg(place).alias(bits)), "id-bitmaps")
    key = F.col(id).cast("long")
    if told.count() > BITMAPS:
        return df.join(wanted.distinct(), key.eqNullSafe(F.col(own)), "left_semi" if inside else "left_anti")
    met = df.withColumn(own, key).join(F.broadcast(told.withColumnRenamed(bucket, f"{bucket}_of")), number.eqNullSafe(F.col(f"{bucket}_of")), "left")
    at = f"bitmap_bit_position(`{own}`)"
    byte = f"cast(conv(hex(substring(`{bits}`, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    there = F.col(bits).isNotNull() & (key.isNull() | F.expr(f"shiftright({byte}, cast({at} % 8 as int)) & 1 = 1"))
    return met.filter(there if inside else ~there).select(*df.columns)
