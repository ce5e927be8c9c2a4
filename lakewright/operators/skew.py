"""Help for joins whose keys are unevenly filled, and for size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's own default for automatic broadcasts.
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024
UNKNOWN_BYTES = 2**63
SALT = "_salt"
SALTS = "_salts"


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's upper estimate of a frame, or a huge number where it has none.

    It starts from file or local sizes, multiplies the sides of joins and never
    shrinks for filters or groupings, but it does not see rows multiplied by an
    explode or a grouping expansion: such frames count as unknown.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if any(node in plan.toString() for node in ("Generate ", "Expand ")):
        return UNKNOWN_BYTES
    return int(str(plan.stats().sizeInBytes()))


def small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark a frame for broadcast only if its estimated size is under the limit.

    Beyond it the frame is returned as it is, so the join shuffles (and AQE may
    still switch to a broadcast from measured sizes).
    """
    return F.broadcast(df) if planned_bytes(df) <= limit_bytes else df


def crowded_keys(df: DataFrame, keys: Sequence[str], share: float = 0.001) -> DataFrame:
    """Keys holding more than ``share`` of the rows, with the number of salts each needs.

    At most ``1 / share`` keys can do so, whatever the size of the frame.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    # a salted key spreads over enough parts for each to stay under the share
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > total * F.lit(share))
        .select(*keys, F.ceil(F.col("_n") / (total * F.lit(share))).cast("int").alias(SALTS))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    residual: Callable[[str, str], Column] | None = None,
    share: float = 0.001,
) -> DataFrame:
    """Inner or left join that spreads the left rows of crowded keys over several tasks.

    Left rows of a crowded key get a salt from the hash of the whole row; the
    right rows of that key are repeated once per salt. Both frames come back
    aliased ``l`` and ``r``. NULL keys match nothing and are spread as well.
    The left frame is read twice more for its keys alone, so store it first if
    it is costly to compute.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be salted on the left")
    crowded = crowded_keys(left.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])), keys, share)
    crowded = F.broadcast(crowded)  # at most 1 / share rows
    spread = F.xxhash64(*[F.col(c) for c in left.columns])
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salted_left = (
        left.join(crowded, list(keys), "left")
        .withColumn(
            SALT,
            F.when(no_key, F.pmod(spread, F.lit(int(1 / share))))
            .otherwise(F.pmod(spread, F.coalesce(F.col(SALTS), F.lit(1))))
            .cast("int"),
        )
        .drop(SALTS)
        .alias("l")
    )
    salted_right = (
        right.join(crowded, list(keys), "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)))
        .drop(SALTS)
        .alias("r")
    )
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, SALT]])
    if residual is not None:
        on = on & residual("l", "r")
    return salted_left.join(salted_right, on, how)
