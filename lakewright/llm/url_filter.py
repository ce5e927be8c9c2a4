"""Allow and block rules for urls, by a sorted sweep over reversed host names.

``www.example.net`` becomes the key ``net.example.www.``; a rule for ``example.net``
and all its subdomains is then the interval from ``net.example.`` up to
``net.example/`` ('/' follows '.' and occurs in no host). Intervals of rules are
nested or disjoint. Starts and ends of intervals and the distinct hosts are dealt
into key ranges and sorted; the sweep carries the stack of rules that are open.
Each url then takes the longest rule of its host's stack whose path begins its own.

The rules of one host travel as one array, so a host may have many rules but not millions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lakewright.llm.tables import settled, unused

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ADDED = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _key_prefixes(key: Column) -> Column:
    """``net.example.www.`` gives ``net.``, ``net.example.`` and itself; what follows the last dot counts for nothing."""
    parts = F.split(key, r"\.", -1)
    labels = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(labels, lambda _, i: F.concat(F.array_join(F.slice(labels, F.lit(1), i + 1), "."), F.lit(".")))


def rule_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a frame, without a Python source."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _rule_nodes(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key and its rules."""
    host = F.translate(F.col("host"), UPPER, UPPER.lower())
    path = F.coalesce("path", F.lit(""))
    entry = F.struct(
        (F.length(host) + F.length(path)).alias("size"), F.length(host).alias("host_size"),
        F.col("verdict").alias("verdict"), F.concat(host, path).alias("rule"), path.alias("path"),
    )
    return (
        rules.filter("host IS NOT NULL AND host <> '' AND verdict IS NOT NULL")
        .select(host_key(host).alias("node"), entry.alias("entry"))
        .groupBy("node").agg(F.collect_set("entry").alias("own"))
    )


def _depth(key: Column) -> Column:
    """The labels of a key: intervals of one depth are disjoint, so a stack has one place for each."""
    return F.size(F.split(key, r"\.", -1)) - 1


def active_rules(hosts: DataFrame, rules: DataFrame, name: str = "active") -> DataFrame:
    """(host, name): for each distinct ``host`` the rules whose host is its own or a parent's.

    In key order the start of an interval pushes its rules to the stack's place of its
    depth and the end pops them. A key range starts from the intervals that are open at
    its first key, the only ones that are looked up by prefixes.
    """
    nodes = settled(_rule_nodes(rules).withColumn("depth", _depth(F.col("node"))), "url-rules")
    deepest = nodes.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("d")).first()["d"]
    no_host, no_rules = F.lit(None).cast("string"), F.lit(None).cast(nodes.schema["own"].dataType)
    push = nodes.select(F.col("node").alias("key"), F.lit(0).alias("kind"), "depth", no_host.alias("host"), F.struct("own").alias("entry"))
    end = F.concat(F.expr("substring(node, 1, length(node) - 1)"), F.lit("/"))
    pop = nodes.select(end.alias("key"), F.lit(0).alias("kind"), "depth", no_host.alias("host"), F.struct(no_rules.alias("own")).alias("entry"))
    points = hosts.select(
        host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.lit(0).alias("depth"), "host", F.lit(None).cast(push.schema["entry"].dataType).alias("entry")
    )
    # stored, so that which range a key fell into is a fact and not a thing to be computed again
    dealt = settled(
        points.unionByName(push).unionByName(pop).repartitionByRange("key", "kind").withColumn("range", F.spark_partition_id()), "url-sweep"
    )
    first = dealt.groupBy("range").agg(F.min("key").alias("first"))
    prefixes = first.select("range", F.explode(_key_prefixes(F.col("first"))).alias("node"))
    seeds = prefixes.join(nodes, "node").select(
        F.lit("").alias("key"), F.lit(-1).alias("kind"), "depth", no_host.alias("host"), F.struct("own").alias("entry"), "range"
    )
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stack = [F.last(F.when(F.col("depth") == k, F.col("entry")), ignorenulls=True).over(sweep)["own"] for k in range(1, deepest + 1)]
    swept = dealt.unionByName(seeds).select("kind", "host", F.array(*stack).cast(ArrayType(nodes.schema["own"].dataType)).alias("stack"))
    return swept.filter("kind = 1").select("host", F.flatten(F.array_compact("stack")).alias(name))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (its text, else null) and ``verdict`` (the rule's, else ``default``).

    A rule fits its host and all subdomains if the url's path starts with the rule's.
    The longest rule (host and path together) wins; of equally long ones that with
    the longer host, then the greater verdict. Null urls and urls without ``://``
    have an empty host and path and get the default. Rules with a null or empty host
    or a null verdict are passed over, a null path counts as empty. Rows are kept one
    for one, repeated rows and empty tables included. Columns of ``pages`` named like
    an added one are replaced.
    """
    kept = [c for c in pages.columns if c not in ADDED]
    placed = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    active, best = unused([*kept, *ADDED], "_active", "_best")
    hosts = active_rules(placed.select("host").distinct(), rules, active)
    fitting = F.filter(active, lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        placed.join(hosts, "host", "left")
        .withColumn(best, F.array_max(fitting))
        .select(
            *kept, "host", "path", F.col(best)["rule"].alias("rule"),
            F.coalesce(F.col(best)["verdict"], F.lit(default)).alias("verdict"),
        )
    )
