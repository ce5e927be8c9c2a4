"""Benchmark passages in training texts, found by spaced seeds and verified around each hit.

A mask such as ``11101011`` takes the hash of the tokens under its ones and ignores
the others. Hashes of all positions of the benchmark's items are joined with those of
all positions of the texts. A hit fixes an alignment of text and item, whose tokens are
then compared one by one: the item counts as found if some window of ``WINDOW`` tokens
of the alignment has at most ``SUBSTITUTIONS`` that differ. The two masks together hit
every such window, whichever tokens differ.

Only DataFrame functions; tokens are compared as 64-bit numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.tables import settled

# Checked by a test: at every placement of up to two differing tokens in 13, one of these fits between them.
MASKS = ("11101011", "11001111")
SPAN = 8
WINDOW, SUBSTITUTIONS = 13, 2
#: Seeds of items (each some 100 bytes, with the item's tokens once per item) up to which they are sent to every task.
BROADCAST_SEEDS = 300_000


def tokens(text: Column) -> Column:
    """The lower-cased words of a text (runs of digits, letters a-z and characters beyond ASCII) as numbers."""
    words = F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(tokens: Column) -> Column:
    """One hash per mask and position, all positions of the first mask before those of the second."""
    last = F.size(tokens) - SPAN
    places = F.sequence(F.lit(0), last)

    def of(mask: str) -> Column:
        taken = [k for k, bit in enumerate(mask) if bit == "1"]
        return F.transform(places, lambda i: F.xxhash64(F.lit(mask), *[F.get(tokens, i + k) for k in taken]))

    return F.when(last >= 0, F.concat(*[of(mask) for mask in MASKS]))


def _seed_rows(df: DataFrame, *carried: str) -> DataFrame:
    """(carried, at, seed): a row per seed of ``tokens`` with its position."""
    return df.withColumn("_seeds", _seeds(F.col("tokens"))).select(
        *carried, F.expr(f"size(tokens) - {SPAN} + 1").alias("_n"), F.posexplode_outer("_seeds").alias("_at", "seed")
    ).select(*carried, (F.col("_at") % F.col("_n")).alias("at"), "seed")


def distinct_items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """(item_id, n_items, item): one row per distinct token sequence of at least ``SPAN`` tokens."""
    return (
        benchmark.select(F.col(id).alias("item_id"), tokens(F.col(text)).alias("item"))
        .filter(F.size("item") >= SPAN)
        .groupBy("item").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"))
        .withColumn("item_no", F.xxhash64("item"))
    )


def _matches(start: str = "start") -> Column:
    """Whether each token of ``item`` equals the text's, laid at token ``start`` of ``tokens`` (which may lie outside)."""
    return F.transform(
        "item", lambda t, k: F.coalesce(F.get("tokens", F.col(start) + k) == t, F.lit(False)).cast("int")
    )


def _alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(id, item_no, start, matches) for each alignment that a seed suggests, from texts' ``tokens``."""
    item_seeds = settled(
        _seed_rows(items.select("item_no", F.col("item").alias("tokens")), "item_no").withColumnRenamed("at", "item_at"), "item-seeds"
    )
    start = (F.col("at") - F.col("item_at")).alias("start")
    of_items = items.select("item_no", "item")
    if item_seeds.count() <= BROADCAST_SEEDS:
        # a text's tokens stay beside its seeds: rows without a hit end before anything is copied
        numbered = docs.withColumn("text_no", F.xxhash64("tokens"))  # rows that share an id may differ in text
        hits = _seed_rows(numbered, "id", "text_no", "tokens").join(F.broadcast(item_seeds), "seed")
        hits = hits.select("id", "text_no", "tokens", "item_no", start)
        placed = hits.join(F.broadcast(of_items), "item_no")
        matches = placed.groupBy("id", "text_no", "item_no", "start").agg(F.first(_matches()).alias("matches"))
        return matches.drop("text_no")
    # many seeds: only numbers are shuffled, then the texts with hits are read again
    hits = _seed_rows(docs, "id").join(item_seeds, "seed").select("id", "item_no", start).distinct()
    read_again = docs.withColumnRenamed("id", "_id")
    placed = settled(hits, "seed-hits").join(read_again, F.col("id").eqNullSafe(F.col("_id")))
    return placed.join(of_items, "item_no").select("id", "item_no", "start", _matches().alias("matches"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(id, item_id, n_items, item_tokens, matched, start): each document and item found in it.

    ``start`` is the text's token at which the item's first token lies (below 0 if the
    text begins within the item), ``matched`` the equal tokens; of several places the
    one with the most counts, then the first. Items with equal tokens are one, under the
    smallest id, and ``n_items`` counts them. Items of 8 to 12 tokens are one window and
    may differ in one token, which the masks do not find at every place of items of 8 or
    9; shorter items and null or empty texts are never found.
    Rows that repeat an id add up to one row per item; a null id is an id like others.
    """
    items = settled(distinct_items(benchmark, item_id, item_text), "items")
    texts = docs.select(F.col(id).alias("id"), tokens(F.col(text)).alias("tokens"))
    window = F.least(F.size("matches"), F.lit(WINDOW))
    needed = window - F.floor(window * SUBSTITUTIONS / WINDOW)

    def in_window(s: Column) -> Column:
        return F.aggregate(F.slice("matches", s, window), F.lit(0), lambda total, m: total + m)

    starts = F.sequence(F.lit(1), F.size("matches") - window + 1)
    found = _alignments(texts, items).filter(F.exists(starts, lambda s: in_window(s) >= needed))
    matched = F.aggregate("matches", F.lit(0), lambda total, m: total + m)
    best = found.groupBy("id", "item_no").agg(F.max(F.struct(matched.alias("matched"), (-F.col("start")).alias("place"))).alias("best"))
    told = items.select("item_no", F.col("item_id").alias("_item_id"), "n_items", F.size("item").alias("item_tokens"))
    return best.join(told, "item_no").select(
        F.col("id").alias(id), F.col("_item_id").alias("item_id"), "n_items", "item_tokens",
        F.col("best.matched").alias("matched"), (-F.col("best.place")).alias("start"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose id has an item in it."""
    bad = settled(contaminated(docs, benchmark, id, text).select(F.col(id).alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, F.col(id).eqNullSafe(F.col("_bad")), "left_anti")
