"""Boilerplate lines by their frequency within a site.

A line is boilerplate of a host if the pages of the host that contain it, divided by
all pages of the host, exceed a ratio. Lines are compared without surrounding spaces,
by their MD5; lines without other characters are never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.tables import settled, unused

ADDED = ("n_lines", "n_dropped")
#: The least ratio tried that keeps 99.9 % of the lines that no three documents but near copies share (sf0.1, see README).
RATIO = 0.006


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def _keys(text: Column) -> Column:
    """The distinct keys of a text's lines; blank lines have none."""
    full = F.filter(_lines(text), lambda line: F.trim(line) != "")
    return F.array_distinct(F.transform(full, _line_key))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, bad): for each host that has any, the keys of its boilerplate lines.

    A host has fewer than (lines per page) / ``ratio`` of them. Pages are counted before
    the shuffle, so a line on a third of all pages moves one row per task.
    """
    per_line = (
        pages.select(F.col(host).alias("host"), F.explode(_keys(F.col(text))).alias("key"))
        .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    totals = pages.groupBy(F.col(host).alias("at_host")).agg(F.count(F.lit(1)).alias("total"))
    return (
        per_line.join(totals, F.col("host").eqNullSafe(F.col("at_host")))
        .filter(F.col("n") > F.lit(ratio) * F.col("total"))
        .groupBy("host").agg(F.collect_set("key").alias("bad"))
    )


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = 3
) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_dropped`` (int).

    All rows stay, repeated ones too; a page that loses all its lines keeps an empty
    text. A line counts once per page. Null hosts form one host of their own, null
    texts stay null with no lines, empty texts have one blank line. Lines end at
    ``\\n``; lines on fewer than ``min_pages`` pages always stay. Copies of a page count
    like others, so a page of which more than ``ratio`` of a host's are copies loses its lines. Columns named like an
    added one are replaced.
    """
    pages = pages.drop(*ADDED)
    bad = settled(boilerplate(pages, host, text, ratio, min_pages), "boilerplate")
    at, listed, hit, left = unused(pages.columns, "_host", "_bad", "_hit", "_clean")
    bad = bad.select(F.col("host").alias(at), F.col("bad").alias(listed))
    # the list's measured size decides whether it is broadcast; else the pages of a crowded host are split
    joined = pages.join(bad, F.col(host).eqNullSafe(F.col(at)), "left")
    found = joined.withColumn(hit, F.when(F.col(listed).isNotNull(), F.array_intersect(_keys(F.col(text)), F.col(listed))))
    lines = _lines(F.col(text))
    clean = F.filter(lines, lambda line: (F.trim(line) == "") | ~F.array_contains(F.col(hit), _line_key(line)))
    shorter = found.withColumn(left, F.when(F.size(hit) > 0, clean))
    return shorter.select(
        *[F.coalesce(F.array_join(left, "\n"), F.col(c)).alias(c) if c == text else F.col(c) for c in pages.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(F.when(F.col(left).isNotNull(), F.size(lines) - F.size(left)), F.lit(0)).alias("n_dropped"),
    )
