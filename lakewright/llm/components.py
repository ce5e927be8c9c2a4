"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.tables import settled


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every end of ``links`` (columns a, b); the component is its smallest node.

    Each step points the neighbours of a node to the smallest of them. Minima are
    combined before the shuffle, and a node with very many links is on the side of the
    join that can be split, so no step gathers the neighbours of one node. Every step's
    links are stored. Loops over the steps until nothing changes, which takes a number
    of them that grows with the logarithm of the longest path.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = settled(edges, label), None
    while True:
        told = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if told["n"] == 0 or told == before:
            break
        before = told
        edges = settled(_small_star(_large_star(edges)), label)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest node among it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(others).distinct()
