"""Slowly changing dimensions and snapshots, as frame algebra.

A version is valid from ``effective_date`` to ``end_date``, both included; the
open version has no ``end_date`` and ``is_current`` set. Dates are days, so one
key gains at most one version per day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.functions.dates import moment
from lakewright.functions.keys import hash_key
from lakewright.operators.joins import all_same, any_differs
from lakewright.operators.windows import keep_latest

VALIDITY = ("effective_date", "end_date", "is_current")
ACTION = "_action"


def prepare_versions(df: DataFrame, keys: Sequence[str], as_of: date, surrogate: str = "version_key") -> DataFrame:
    """Incoming rows as open versions of ``as_of``: key hash first, validity last."""
    day = moment(as_of, "date")
    return df.select(
        hash_key([*keys, day.cast("string")]).alias(surrogate),
        *df.columns,
        day.alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def scd2_plan(dim: DataFrame, incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: date) -> DataFrame:
    """The whole new dimension, each row tagged with what happened to it.

    ``incoming`` has the dimension's columns (see ``prepare_versions``) and one
    row per key. Tags: ``history``, ``kept``, ``expired``, ``replaced`` (changed
    again on the day it was opened), ``new_version``, ``new_entity``. NULL is a key like
    others. A batch that would change a version opened after ``as_of`` stops the job,
    whichever columns are read: load batches in order of their days, or keep a history
    that ``scd2_repair`` can change.
    """
    names = dim.columns
    opened = dim.filter("is_current").alias("o")
    known = dim.filter(~F.col("is_current")).select(*keys).distinct().withColumn("_known", F.lit(True)).alias("k")
    arrived = incoming.select(*names).withColumn("_arrived", F.lit(True)).alias("a")
    arriving = arrived.join(known, all_same("a", "k", keys), "left").select("a.*", "k._known").alias("n")
    day = moment(as_of, "date")

    has_old, has_new = F.col("o.is_current").isNotNull(), F.col("n._arrived").isNotNull()
    differs = any_differs("o", "n", tracked)
    same_day = F.col("o.effective_date") == day

    def row(side: str, tag: Column, **changes: Column) -> Column:
        return F.struct(
            tag.alias(ACTION), *[changes.get(c, F.col(f"{side}.{c}")).alias(c) for c in names]
        )

    would_change = has_old & has_new & differs
    late = would_change & (F.col("o.effective_date") > day)
    refused = F.raise_error(F.concat(F.lit("late batch: a version is open since "), F.col("o.effective_date").cast("string")))
    # decides which rows there are, so no choice of columns leaves it out
    changed = F.when(late, refused.cast("boolean")).otherwise(would_change)
    expired = row("o", F.lit("expired"), end_date=F.date_sub(day, 1), is_current=F.lit(False))
    kept = row("o", F.lit("kept"))
    first_seen = F.when(F.col("n._known"), F.lit("new_version")).otherwise(F.lit("new_entity"))
    new_tag = F.when(has_old & same_day, F.lit("replaced")).when(has_old, F.lit("new_version")).otherwise(first_seen)
    versions = F.array_compact(
        F.array(
            F.when(changed & ~same_day, expired).when(has_old & ~changed, kept),
            F.when(has_new & (changed | ~has_old), row("n", new_tag)),
        )
    )
    moved = (
        opened.join(arriving, all_same("o", "n", keys), "full")
        .select(F.explode(versions).alias("_v"))
        .select("_v.*")
    )
    past = dim.filter(~F.col("is_current")).select(F.lit("history").alias(ACTION), *names)
    return moved.unionByName(past)


def scd2_apply(dim: DataFrame, incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: date) -> DataFrame:
    """The dimension after a batch, as one frame for one write."""
    return scd2_plan(dim, incoming, keys, tracked, as_of).drop(ACTION)


def scd2_statistics(plan: DataFrame) -> DataFrame:
    """Seven counts of a tagged plan, in one pass."""

    def tagged(*tags: str) -> Column:
        return F.count_if(F.col(ACTION).isin(*tags))

    before = tagged("history", "kept", "expired", "replaced")
    after = F.count(F.lit(1))
    return plan.agg(
        before.alias("before"),
        after.alias("after"),
        F.count_if(F.col("is_current")).alias("current_records"),
        F.count_if(~F.col("is_current")).alias("historical_records"),
        (after - before).alias("net_change"),
        tagged("expired", "replaced").alias("changed_keys"),
        tagged("new_entity").alias("new_entities"),
    )


def scd2_from_log(
    log: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: str, tie_breakers: Sequence[str]
) -> DataFrame:
    """Version history from a change log.

    The log is cut to the last change per key and day before the shuffle, so a
    key's series is as long as the calendar however busy the key is. Days that
    change nothing are dropped, and a version ends the day before the next.
    """
    daily = keep_latest(
        log.withColumn("effective_date", F.to_date(at)), [*keys, "effective_date"], at, tie_breakers
    ).select(*keys, *tracked, "effective_date")
    series = Window.partitionBy(*keys).orderBy("effective_date")
    state = F.struct(*tracked)
    changes = daily.withColumn("_before", F.lag(state).over(series)).filter(
        F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)
    )
    following = F.lead("effective_date").over(series)
    return changes.select(
        *keys,
        *tracked,
        "effective_date",
        F.date_sub(following, 1).alias("end_date"),
        following.isNull().alias("is_current"),
    )


SEEN = "_seen"


def scd2_open(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: str, tie_breakers: Sequence[str]) -> DataFrame:
    """The history of ``scd2_from_log`` with ``_seen``: what ``scd2_repair`` needs to change it later.

    ``_seen`` lists for every day on which the version's state was observed the time and
    tie-breakers of the day's last change, so it is no longer than the calendar.
    """
    return _versions(_marked(log, keys, tracked, at, tie_breakers), keys, tracked, len(tie_breakers))


def scd2_repair(
    dim: DataFrame, log: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: str, tie_breakers: Sequence[str]
) -> DataFrame:
    """The history after more of the change log, which may be older than what is known.

    A late change splits the version that covers its day, ends it at the next day on which
    another state was observed, and melts into an equal neighbour. Only keys of the batch
    are worked on; the versions of all others pass by. Batches in any order, repeated ones
    included, give the history that their whole log gives. NULL is a key like others.
    ``dim`` comes from ``scd2_open`` or from here and is read twice.
    """
    touched = log.select(*keys).distinct().withColumn("_hit", F.lit(True)).alias("t")
    flagged = dim.alias("d").join(touched, all_same("d", "t", keys), "left").select("d.*", "t._hit")
    n = len(tie_breakers) + 1
    observed = flagged.filter("_hit").select(*keys, *tracked, F.explode(SEEN).alias("_mark"))
    observed = observed.select(*keys, *tracked, *[F.col(f"_mark._m{i}").alias(f"_m{i}") for i in range(n)])
    rebuilt = _versions(observed.unionByName(_marked(log, keys, tracked, at, tie_breakers)), keys, tracked, len(tie_breakers))
    return flagged.filter("_hit IS NULL").drop("_hit").unionByName(rebuilt)


def _marked(log: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: str, tie_breakers: Sequence[str]) -> DataFrame:
    return log.select(*keys, *tracked, *[F.col(c).alias(f"_m{i}") for i, c in enumerate([at, *tie_breakers])])


def _versions(observed: DataFrame, keys: Sequence[str], tracked: Sequence[str], n_ties: int) -> DataFrame:
    marks = [f"_m{i}" for i in range(n_ties + 1)]
    daily = keep_latest(observed.withColumn("effective_date", F.to_date("_m0")), [*keys, "effective_date"], "_m0", marks[1:])
    series = Window.partitionBy(*keys).orderBy("effective_date")
    state = F.struct(*tracked)
    before = F.lag(state).over(series)
    opens = (before.isNull() | ~before.eqNullSafe(state)).cast("int")
    runs = daily.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(series))
    versions = runs.groupBy(*keys, "_run").agg(
        *[F.first(c).alias(c) for c in tracked], F.min("effective_date").alias("effective_date"), F.sort_array(F.collect_list(F.struct(*marks))).alias(SEEN)
    )
    following = F.lead("effective_date").over(series)
    return versions.select(
        *keys, *tracked, "effective_date", F.date_sub(following, 1).alias("end_date"), following.isNull().alias("is_current"), SEEN
    )


def scd2_invariants(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts that are all zero for a sound dimension, from one grouping."""
    per_key = dim.groupBy(*keys).agg(
        F.count_if(F.col("is_current")).alias("_open"),
        F.count_if(F.col("is_current") & F.col("end_date").isNotNull()).alias("_open_ended"),
        F.count_if(~F.col("is_current") & F.col("end_date").isNull()).alias("_closed_endless"),
        F.count_if(F.col("end_date") < F.col("effective_date")).alias("_reversed"),
    )
    return per_key.agg(
        F.count_if(F.col("_open") > 1).alias("keys_with_two_current"),
        F.coalesce(F.sum("_open_ended"), F.lit(0)).alias("current_with_end"),
        F.coalesce(F.sum("_closed_endless"), F.lit(0)).alias("history_without_end"),
        F.coalesce(F.sum("_reversed"), F.lit(0)).alias("end_before_start"),
    )


def snapshot_start(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """First snapshot of a source: every row open since its own update time."""
    return source.select(
        *source.columns,
        hash_key([key, updated_at], "md5").alias("version_key"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(source.schema[updated_at].dataType).alias("valid_to"),
    )


def snapshot(
    current: DataFrame,
    source: DataFrame,
    key: str,
    updated_at: str,
    as_of: datetime,
    hard_deletes: str = "invalidate",
) -> DataFrame:
    """Snapshot after another look at the source, by the update-time strategy.

    A row whose ``updated_at`` moved on is closed at the new time and opened
    again; a key that left the source is closed at ``as_of`` (or left open with
    ``hard_deletes='ignore'``); closed rows pass through. NULL is a key like others.
    """
    if hard_deletes not in ("invalidate", "ignore"):
        raise ValueError(f"unknown hard_deletes '{hard_deletes}'")
    names = current.columns
    at_type = current.schema["valid_to"].dataType
    opened = current.filter("valid_to IS NULL").withColumn("_open", F.lit(True)).alias("o")
    seen = snapshot_start(source, key, updated_at).withColumn("_seen", F.lit(True)).alias("n")
    has_old, has_new = F.col("o._open").isNotNull(), F.col("n._seen").isNotNull()
    newer = has_old & has_new & (F.col(f"n.{updated_at}") > F.col("o.valid_from"))
    gone = has_old & ~has_new if hard_deletes == "invalidate" else F.lit(False)
    closing = F.when(newer, F.col(f"n.{updated_at}")).when(gone, moment(as_of, at_type))

    def row(side: str, valid_to: Column) -> Column:
        return F.struct(*[(valid_to if c == "valid_to" else F.col(f"{side}.{c}")).alias(c) for c in names])

    rows = F.array_compact(
        F.array(
            F.when(has_old, row("o", closing)),
            F.when(has_new & (newer | ~has_old), row("n", F.col("n.valid_to"))),
        )
    )
    moved = (
        opened.join(seen, F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "full")
        .select(F.explode(rows).alias("_v"))
        .select("_v.*")
    )
    return moved.unionByName(current.filter("valid_to IS NOT NULL"))
