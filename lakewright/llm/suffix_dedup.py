"""Removal of every byte that a repeated string of fixed length covers, by suffix arrays of shards.

Every window of ``length`` bytes has an anchor: its leftmost ``ANCHOR``-byte string with the
least hash. Windows in a row that share an anchor form a snippet, so each window of each
text is in exactly one snippet, and equal windows have equal anchors. Shards are made of
whole anchors: the snippets that share one are sorted together by induced sorting, and the
permuted common prefixes tell which windows start elsewhere, too.

Before that, texts that are equal become one, anchors that stand at one place only are left
out, and of equal snippets (same 128-bit digest) one is sorted; their windows are all
repeated. An anchor with more than ``CROWD`` different snippets, such as the edge of a
passage that stands in very many texts, is not sorted as a whole. Its snippets are cut by
the anchor's place in a window, and each part takes the bytes that all its windows hold, its
core, for an anchor: equal windows are in equal parts. Parts whose core stands once go,
equal ones become one, and those that share a core are sorted as snippets are; only the
windows of cores that are crowded still are counted by their 128-bit digests, which combine
before the shuffle. All ways give every repeated window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.batches import column, gather, slices
from lakewright.llm.grouped import map_groups
from lakewright.llm.shingles import mix
from lakewright.llm.suffix_array import common_prefixes, suffix_array
from lakewright.llm.tables import settled, unused

LENGTH, ANCHOR = 200, 48
#: Different snippets of an anchor up to which they are sorted in one shard.
CROWD = 1500
#: Ranges of an anchor's places in a window, each with a core of its own: in choosing what is sorted, and in cutting crowded snippets.
PARTS, CUTS = 8, 12
#: Bytes of snippets in a shard on average, windows hashed at a time, and bytes of text in a slice.
SHARD, BLOCK, BYTES = 600_000, 1_000_000, 2_000_000

_RANDOM = np.random.default_rng(1201)
CODES = _RANDOM.integers(0, 2**64, (2, 256), dtype=np.uint64)
BASES = [int(x) * 2 + 1 for x in _RANDOM.integers(2**61, 2**62, 2)]


@lru_cache(maxsize=2)
def powers(side: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse, modulo 2^64."""
    base = BASES[side]
    told = []
    for x in (base, pow(base, -1, 2**64)):
        steps = np.full(n, x, np.uint64)
        steps[0] = 1
        told.append(np.cumprod(steps, dtype=np.uint64))
    return told[0], told[1]


class Hashes:
    """Hashes of all strings of a block of bytes."""

    def __init__(self, flat: np.ndarray, most: int):
        self.told = []
        for side in range(2):
            up, self_down = powers(side, most)
            sums = np.zeros(len(flat) + 1, np.uint64)
            np.cumsum(CODES[side][flat] * up[: len(flat)], out=sums[1:])
            self.told.append((sums, self_down))

    def of(self, side: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums, down = self.told[side]
        return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least of each ``width`` values in a row."""
    n, far = len(values), np.iinfo(np.int64).max
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks, place = padded.reshape(rows, width), np.arange(rows * width).reshape(rows, width)
    upto = np.minimum.accumulate(blocks, axis=1)
    new = np.ones(blocks.shape, bool)
    new[:, 1:] = blocks[:, 1:] < upto[:, :-1]
    upto_place = np.maximum.accumulate(np.where(new, place, 0), axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]
    new = np.ones(blocks.shape, bool)
    new[:, :-1] = blocks[:, :-1] <= onward[:, 1:]
    onward_place = np.minimum.accumulate(np.where(new, place, far)[:, ::-1], axis=1)[:, ::-1].ravel()
    first, last = np.arange(n - width + 1), np.arange(width - 1, n)
    return np.where(onward.ravel()[first] <= upto.ravel()[last], onward_place[first], upto_place[last])


def snippets_of(flat: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, windows, anchor, digest's halves) of the texts between ``bounds``, block by block.

    A block's edge may cut a snippet in two; its windows keep their anchor.
    """
    ends = np.repeat(bounds[1:], np.diff(bounds))
    for at in range(0, len(flat), BLOCK):
        part = flat[at : at + BLOCK + length - 1]
        n = len(part) - length + 1
        if n < 1:
            break
        hashes, kmers = Hashes(part, BLOCK + length), np.arange(len(part) - ANCHOR + 1)
        values = hashes.of(0, kmers, kmers + ANCHOR)
        anchors = least_places(values, length - ANCHOR + 1)
        whole = np.arange(at, at + n) + length <= ends[at : at + n]
        begins = whole.copy()
        begins[1:] &= ~whole[:-1] | (anchors[1:] != anchors[:-1])
        first = np.flatnonzero(begins)
        windows = np.add.reduceat(whole, first) if len(first) else np.zeros(0, np.int64)
        stop = first + windows + length - 1
        text = np.searchsorted(bounds, first + at, side="right") - 1
        yield text, first + at - bounds[text], windows, values[anchors[first]], hashes.of(0, first, stop), hashes.of(1, first, stop)


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    array = array.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, bounds - bounds[0]


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """(class, digest, bytes, copies): one row per different text; null is empty."""
    source = df.select(text_digest(F.col(text)).alias("digest"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("bytes"))
    classes = source.groupBy("digest").agg(F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("copies"))
    return settled(classes.withColumn("class", F.monotonically_increasing_id()), "distinct-texts")


def text_digest(text: Column) -> Column:
    """128 bits of the text's sha256; null is empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256), 1, 32))


def anchored(classes: DataFrame, length: int) -> DataFrame:
    """(class, copies, start, windows, anchor, d1, d2): the snippets of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", BYTES):
                ids, copies = (column(part, c).to_numpy() for c in ("class", "copies"))
                for text, start, windows, *hashes in snippets_of(*flat_bytes(column(part, "bytes")), length):
                    told = [ids[text], copies[text], start, windows, *(h.view(np.int64) for h in hashes)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in told], ["class", "copies", "start", "windows", "anchor", "d1", "d2"])

    return classes.filter(F.length("bytes") >= length).select("class", "copies", "bytes").mapInArrow(run, SNIPPETS)


def live_snippets(snippets: DataFrame) -> DataFrame:
    """The snippets (stored) that may hold a repeated window, with their occurrences ``n`` and the different snippets of their anchor."""
    equal = snippets.groupBy("anchor", "d1", "d2").agg(F.sum("copies").alias("n"))
    equal = settled(equal, "equal-snippets")
    repeated = equal.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_different"), F.sum("n").alias("total")).filter("total > 1")
    known = equal.join(repeated.select("anchor", "n_different"), "anchor")
    return settled(snippets.drop("copies").join(known, ["anchor", "d1", "d2"]), "live-snippets")


def snippet_bytes(live: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """(anchor, d1, d2, n, n_different, windows, bytes): one of each different snippet whose anchor has more than one."""
    open_ = live.filter("n_different > 1")
    # a snippet that stands once is its own example; of the others any serves, and stored is stored
    once = open_.filter("n = 1").select("class", "start", "windows", "anchor", "d1", "d2", "n", "n_different")
    more = open_.filter("n > 1").groupBy("anchor", "d1", "d2").agg(*[F.first(c).alias(c) for c in ("class", "start", "windows", "n", "n_different")])
    chosen = once.unionByName(more).groupBy("class").agg(F.collect_list(F.struct("start", "windows", "anchor", "d1", "d2", "n", "n_different")).alias("chosen"))
    joined = classes.select("class", "bytes").join(chosen, "class")
    names = ["start", "windows", "anchor", "d1", "d2", "n", "n_different"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", BYTES):
                flat, bounds = flat_bytes(column(part, "bytes"))
                lists = column(part, "chosen")
                told = {n: lists.flatten().field(n).to_numpy(zero_copy_only=False) for n in names}
                first = np.repeat(bounds[:-1], lists.value_lengths().to_numpy(zero_copy_only=False)) + told["start"]
                sizes = told["windows"] + length - 1
                cut = flat[gather(first, sizes)]
                offsets = pa.py_buffer(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                cuts = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(np.ascontiguousarray(cut))])
                yield pa.RecordBatch.from_arrays([*(pa.array(told[n]) for n in names[1:]), cuts], [*names[1:], "bytes"])

    return settled(joined.mapInArrow(run, "windows long, anchor long, d1 long, d2 long, n long, n_different long, bytes binary"), "snippet-bytes")


RANGES = "d1 long, d2 long, lo long, hi long"
SNIPPETS = "class long, copies long, start long, windows long, anchor long, d1 long, d2 long"


def all_of(texts: list[bytes], anchors: np.ndarray, length: int) -> np.ndarray:
    return np.ones(len(texts), bool)


def sorted_ranges(open_: DataFrame, length: int, choice: Callable[[list[bytes], np.ndarray, int], np.ndarray]) -> DataFrame:
    """(d1, d2, lo, hi): the repeated windows of snippets, found by a suffix array of those of each shard that ``choice`` takes."""
    size = open_.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0)).alias("size")).first()["size"]
    sharded = open_.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(max(1, math.ceil(size / SHARD)))))

    def work(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        texts, anchors = frame["bytes"].tolist(), frame["anchor"].to_numpy().view(np.uint64)
        chosen = [lo + np.flatnonzero(choice(texts[lo:hi], anchors[lo:hi], length)) for lo, hi in zip(bounds, bounds[1:])]
        found = [repeated_runs([texts[k] for k in some], length) for some in chosen]
        snippet = np.concatenate([some[k] for (k, _, _), some in zip(found, chosen)])
        runs = frame[["d1", "d2"]].iloc[snippet].reset_index(drop=True)
        return runs.assign(lo=np.concatenate([x for _, x, _ in found]), hi=np.concatenate([x for _, _, x in found]))

    return map_groups(sharded.select("shard", "anchor", "d1", "d2", "bytes"), "shard", work, RANGES)


def cores(length: int, parts: int) -> list[tuple[int, int, int, int]]:
    """(first, last, left, right): places of a window's anchor, and the bytes on each side of it that all windows with these places hold."""
    rest = length - ANCHOR
    edges = [k * (rest + 1) // parts for k in range(parts + 1)]
    return [(lo, hi - 1, lo, rest - hi + 1) for lo, hi in zip(edges, edges[1:]) if lo < hi]


def anchor_places(hashes: Hashes, begins: np.ndarray, anchors: np.ndarray, length: int) -> np.ndarray:
    """Where the anchor of each snippet stands: its first window holds it, and it is the leftmost string of its hash there."""
    places = begins[:, None] + np.arange(length - ANCHOR + 1)
    return begins + np.argmax(hashes.of(0, places, places + ANCHOR) == anchors[:, None], axis=1)


def may_repeat(texts: list[bytes], anchors: np.ndarray, length: int) -> np.ndarray:
    """Which snippets, all those of their anchors, share with another all but a few bytes of some window, around the anchor.

    Equal windows have their anchor at the same place. So a window that begins elsewhere,
    too, shares with its equal the anchor's core for the place's range: the others hold no
    repeated window, and none is lost. Hashes that agree by chance keep a snippet.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(texts), np.uint8)
    hashes = Hashes(flat, 1 << len(flat).bit_length())
    at = anchor_places(hashes, begins, anchors, length)
    kept = np.zeros(len(texts), bool)
    for _, _, left, right in cores(length, PARTS):
        there = np.flatnonzero((at - left >= begins) & (at + ANCHOR + right <= begins + sizes))
        _, of, counts = np.unique(hashes.of(0, at[there] - left, at[there] + ANCHOR + right), return_inverse=True, return_counts=True)
        kept[there[counts[of] > 1]] = True
    return kept


def repeated_runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, stop) of all runs of places where a string of ``length`` begins that begins elsewhere, too."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    # 0 ends the shard, 1 each text; neither agrees with anything
    s = np.zeros(int(sizes.sum()) + 1, np.int32)
    s[:-1] = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int32) + 2
    starts = np.cumsum(sizes) - sizes
    s[starts + sizes - 1] = 1
    prefix, before = common_prefixes(s, suffix_array(s), 1)
    here = np.flatnonzero(prefix >= length)
    repeated = np.zeros(len(s) + 1, np.int8)
    repeated[here] = repeated[before[here]] = 1
    steps = np.diff(repeated, prepend=0)
    first, stop = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    text = np.searchsorted(starts, first, side="right") - 1
    return text, first - starts[text], stop - starts[text]


def counted_ranges(open_: DataFrame, length: int) -> DataFrame:
    """(d1, d2, lo, hi): the same for snippets of anchors that are crowded, by counting the digests of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", BLOCK // 4):
                flat, bounds = flat_bytes(column(part, "bytes"))
                hashes = Hashes(flat, BLOCK + length)
                windows = np.diff(bounds) - length + 1
                at = gather(bounds[:-1], windows)
                row = np.repeat(np.arange(len(windows)), windows)
                own = [column(part, c).to_numpy()[row] for c in ("d1", "d2", "n")]
                told = [*own, at - bounds[row], *(hashes.of(side, at, at + length).view(np.int64) for side in range(2))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in told], ["d1", "d2", "n", "lo", "w1", "w2"])

    windows = open_.select("d1", "d2", "n", "bytes").mapInArrow(run, "d1 long, d2 long, n long, lo long, w1 long, w2 long")
    windows = settled(windows, "crowded-windows")
    repeated = windows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).filter("total > 1").select("w1", "w2")
    return windows.filter("n = 1").join(repeated, ["w1", "w2"]).select("d1", "d2", "lo", (F.col("lo") + 1).alias("hi"))


def cut_parts(crowded: DataFrame, length: int) -> DataFrame:
    """(class, copies, start, windows, anchor, d1, d2): crowded snippets (a class each) cut by the anchor's place, with the cores as anchors.

    Each window of a snippet is in exactly one of its parts. Equal windows have their anchor
    at the same place, and so the same core: a part is a snippet with an anchor of its own.
    """
    ranges = cores(length, CUTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", BLOCK // 4):
                flat, bounds = flat_bytes(column(part, "bytes"))
                ids, copies, anchors = (column(part, c).to_numpy() for c in ("class", "copies", "anchor"))
                hashes, begins, windows = Hashes(flat, 1 << (len(flat) + length).bit_length()), bounds[:-1], np.diff(bounds) - length + 1
                at = anchor_places(hashes, begins, anchors.view(np.uint64), length)
                place = at - begins
                for k, (lo, hi, left, right) in enumerate(ranges):
                    # the windows that begin hi to lo bytes before the anchor
                    first, stop = np.maximum(place - hi, 0), np.minimum(place - lo + 1, windows)
                    there = np.flatnonzero(first < stop)
                    a, z, here = begins[there] + first[there], begins[there] + stop[there] + length - 1, at[there]
                    core = mix(hashes.of(0, here - left, here + ANCHOR + right) + np.uint64(k))
                    told = [ids[there], copies[there], first[there], (stop - first)[there], *(x.view(np.int64) for x in (core, hashes.of(0, a, z), hashes.of(1, a, z)))]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in told], ["class", "copies", "start", "windows", "anchor", "d1", "d2"])

    return crowded.select("class", "copies", "anchor", "bytes").mapInArrow(run, SNIPPETS)


def crowded_ranges(open_: DataFrame, length: int) -> DataFrame:
    """(d1, d2, lo, hi): the repeated windows of snippets of crowded anchors, found by their parts."""
    crowded = open_.select("anchor", "d1", "d2", F.col("n").alias("copies"), "bytes").withColumn("class", F.monotonically_increasing_id())
    crowded = settled(crowded, "crowded-snippets")
    # parts in one core share it already
    found = repeated_windows(crowded, settled(cut_parts(crowded, length), "crowded-parts"), length, all_of, counted_ranges)
    # what stands more than once is repeated as a whole
    return found.join(crowded.filter("copies = 1").select("class", "d1", "d2"), "class").select("d1", "d2", "lo", "hi")


def repeated_windows(
    classes: DataFrame, snippets: DataFrame, length: int, choice: Callable[[list[bytes], np.ndarray, int], np.ndarray],
    of_crowded: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """(class, lo, hi): the repeated windows of stored ``snippets`` of ``classes``; ``of_crowded`` finds those of crowded anchors."""
    live = live_snippets(snippets)
    open_ = snippet_bytes(live, classes, length)
    found = sorted_ranges(open_.filter(F.col("n_different") <= CROWD), length, choice)
    found = settled(found.unionByName(of_crowded(open_.filter(F.col("n_different") > CROWD), length)), "repeated-windows")
    whole = live.filter("n > 1").select("class", F.col("start").alias("lo"), (F.col("start") + F.col("windows")).alias("hi"))
    single = live.filter("n = 1 AND n_different > 1").join(found, ["d1", "d2"])
    partly = single.select("class", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    return whole.unionByName(partly)


def repeated_ranges(classes: DataFrame, length: int) -> DataFrame:
    """(class, lo, hi): byte ranges of distinct texts that are covered by repeated windows; they may overlap."""
    found = repeated_windows(classes, settled(anchored(classes, length), "snippets"), length, may_repeat, crowded_ranges)
    return found.select("class", "lo", (F.col("hi") + (length - 1)).alias("hi"))


def without_ranges(classes: DataFrame, ranges: DataFrame) -> DataFrame:
    """(digest, n_bytes, n_removed, n_spans, kept) of distinct texts, ``kept`` as bytes."""
    gathered = ranges.groupBy("class").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    joined = classes.select("class", "digest", "bytes").join(gathered, "class", "left").drop("class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", BYTES):
                flat, bounds = flat_bytes(column(part, "bytes"))
                lists = column(part, "ranges")
                counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                base = np.repeat(bounds[:-1], counts)
                told = lists.flatten()
                lo, hi = (told.field(c).to_numpy(zero_copy_only=False).astype(np.int64) + base for c in ("lo", "hi"))
                edges = np.bincount(lo, minlength=len(flat) + 1) - np.bincount(hi, minlength=len(flat) + 1)
                gone = np.cumsum(edges)[: len(flat)] > 0
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                firsts = bounds[:-1][bounds[:-1] < len(flat)]
                begins[firsts] = gone[firsts]
                n_gone, n_spans = (np.diff(np.concatenate(([0], np.cumsum(x)))[bounds]) for x in (gone, begins))
                n_bytes = np.diff(bounds)
                offsets = np.concatenate(([0], np.cumsum(n_bytes - n_gone)))
                kept = pa.Array.from_buffers(pa.large_binary(), len(n_bytes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat[~gone])])
                yield pa.RecordBatch.from_arrays(
                    [column(part, "digest"), pa.array(n_bytes), pa.array(n_gone), pa.array(n_spans), kept.cast(pa.binary())],
                    ["digest", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return joined.mapInArrow(run, "digest binary, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(
    df: DataFrame, text: str = "text", length: int = LENGTH, kept_as: Callable[[Column], Column] = lambda kept: kept, name: str = "kept"
) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``name``: what is left of the UTF-8 bytes of ``text``.

    Every byte goes that is covered by a string of ``length`` bytes (more than ``ANCHOR``)
    that also starts anywhere else, in the same text or another row, repeated rows included;
    matches do not cross texts. Strings are judged on the input. A cut may fall inside a
    character, so what is left are bytes; ``kept_as`` turns them into what is wanted, once
    per different text. ``n_spans`` counts the maximal runs that went. Null texts count as
    empty; texts under ``length`` bytes stay whole; an empty table gives no rows. Columns
    named like the new ones are replaced, all others stay.
    """
    if length <= ANCHOR:
        raise ValueError(f"strings of {ANCHOR} bytes or less have no anchor")
    digest = unused(df.columns, "_digest")[0]
    classes = distinct_texts(df, text)
    told = without_ranges(classes, repeated_ranges(classes, length)).withColumn("kept", kept_as(F.col("kept")))
    told = settled(told.select(F.col("digest").alias(digest), "n_bytes", "n_removed", "n_spans", F.col("kept").alias(name)), "kept-bytes")
    rows = df.withColumn(digest, text_digest(F.col(text))).drop("n_bytes", "n_removed", "n_spans", *([] if name == text else [name]))
    return (rows.drop(text) if name == text else rows).join(told, digest).drop(digest)
