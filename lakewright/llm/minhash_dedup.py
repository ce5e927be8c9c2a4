"""Near-duplicate documents by a chosen-path set similarity join.

Each text is the set of its distinct word shingles. Texts with equal sets form one
class; all that follows works on classes, so copies cost one row each. A class is
embedded as a signature of ``SIGNATURE`` minwise tokens. In each of several independent
trees, classes are dealt into nodes by one minwise token; a node with more than ``LEAF``
classes is branched again, at most ``DEPTH`` times, by ``BRANCHES`` choices of ``STEP``
further tokens, drawn by the node's own path. Small nodes are compared exhaustively.

Links are needed for components only, and exact. So in every root each class is first
compared with the root's smallest, and a node whose classes are all in one component
needs no further comparison: a group of thousands of near copies takes about one
comparison per member and tree. From other large roots, classes that by their sizes and
shared tokens can be linked with nothing in another component are left out, which is
exact; the others are compared with the class that shares the most, the root's hub, and
again those left out that can be linked with no other component any more. What remains
is branched, unless its classes are alike already, in which case branching would only
repeat them. At the ends of the paths, classes whose sizes and signatures may fit one of
another component are compared on full sets; a unit of work gives no more links than it
has classes. In ends that are still large, what is not in the node's greatest component
is compared, in blocks, with all of it.

Trees start from different places of the signature, and a branch takes STEP different
ones. ``missed`` gives the probability that a pair at the threshold meets in no tree;
the number of trees follows from that and the recall.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.batches import slices
from lakewright.llm.components import components
from lakewright.llm.grouped import map_groups
from lakewright.llm.shingles import mix, shingle_sets
from lakewright.llm.tables import rows_with, settled

SIGNATURE, LEAF, BRANCHES, STEP, DEPTH = 64, 48, 4, 2, 4
#: Classes in a block of a node that stays large: fewer blocks repeat their classes less often.
BLOCK = 128
#: Mean agreement with a node's first class from which a large node is not branched.
ALIKE = 0.35
#: Cells of the table of classes by tokens that are filled at a time.
CELLS = 1_000_000
#: Rows with a text or a full set, some kilobytes each, that go to a Python worker at once.
ROWS = 1000
#: Bytes of text that a task turns into shingles at a time.
BYTES = 500_000
SEEDS = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


#: Trees beyond which no recall is looked for.
MOST_TREES = 4 * SIGNATURE


def root_places(trees: int, seed: int) -> list[int]:
    """The signature's place of each tree's root: a permutation, so none is used twice before all have been."""
    order = random.Random(seed).sample(range(SIGNATURE), SIGNATURE)
    return [order[t % SIGNATURE] for t in range(trees)]


def missed(percent: int, places: Sequence[int]) -> float:
    """The probability that a pair at the threshold meets in no tree of these roots, or agrees in too few places to be compared.

    Given the number m of places in which the pair agrees, branches are independent: a tree
    whose root agrees is followed to its end with a probability that depends on m only.
    """
    t, least, total = percent / 100, least_agreement(percent), 0.0
    uses = np.bincount(np.array(places, np.int64), minlength=SIGNATURE)
    for m in range(SIGNATURE + 1):
        both = math.comb(m, STEP) / math.comb(SIGNATURE, STEP)
        weights = (1 - (1 - (1 - both) ** BRANCHES) ** DEPTH) ** uses if m >= least else np.ones(SIGNATURE)
        sums = np.zeros(SIGNATURE + 1)  # per number of agreeing places: the probability of no meeting, times that of the places
        sums[0] = 1.0
        for weight in weights:
            sums[1:], sums[0] = sums[1:] * (1 - t) + sums[:-1] * t * weight, sums[0] * (1 - t)
        total += float(sums[m])
    return total


@lru_cache(maxsize=64)
def trees_for(percent: int, recall: float) -> int:
    """The least number of trees with which a pair at the threshold is missed with a probability below 1 - ``recall``."""
    for trees in range(1, MOST_TREES + 1):
        if missed(percent, root_places(trees, 0)) < 1 - recall:
            return trees
    raise ValueError(f"signatures of {SIGNATURE} places do not give a recall of {recall} at {percent} %")


def least_agreement(percent: int, miss: float = 1e-7) -> int:
    """The signature places in which a pair at the threshold agrees, but for a probability of ``miss``."""
    t, below = percent / 100, 0.0
    for k in range(SIGNATURE):
        below += math.comb(SIGNATURE, k) * t**k * (1 - t) ** (SIGNATURE - k)
        if below > miss:
            return k
    return SIGNATURE


def _signature(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each set and seed the upper half of the least scrambled token."""
    columns = [np.minimum.reduceat(mix(sets ^ seed), starts) >> np.uint64(32) for seed in SEEDS]
    return np.stack(columns, axis=1).astype(np.uint32).view(np.int32)


def sketches(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(id, n_shingles, class, signature) of each row; class and signature are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BYTES):
                sets, counts = shingle_sets(part.column(1), words)
                full = np.flatnonzero(counts)
                ends = np.cumsum(counts)
                starts = (ends - counts)[full]
                classes: list[bytes | None] = [None] * len(counts)
                signatures: list[np.ndarray | None] = [None] * len(counts)
                if len(full):
                    for row, signature in zip(full, _signature(sets, starts)):
                        signatures[row] = signature
                        classes[row] = hashlib.blake2b(sets[ends[row] - counts[row] : ends[row]].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(counts), pa.array(classes, pa.binary()), pa.array(signatures, pa.list_(pa.int32())),
                    ],
                    ["id", "n_shingles", "class", "signature"],
                )

    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "id long, n_shingles long, class binary, signature array<int>")


def full_sets(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(class, tokens): the full sets of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BYTES):
                sets, counts = shingle_sets(part.column(1), words)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                keys = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, bounds[1:])]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], ["class", "tokens"])

    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "class binary, tokens array<long>")


def _token(place: Column) -> Column:
    """The signature's token at a place."""
    return F.element_at("signature", (place + 1).cast("int"))


def branch_places(node: Column, branch: int) -> list[Column]:
    """STEP different places of the signature, drawn by a node's path alone."""
    places: list[Column] = []
    for k in range(STEP):
        # the drawn one of the places that are left
        place = F.pmod(F.xxhash64(node, F.lit(branch), F.lit(k)), F.lit(SIGNATURE - k))
        for taken in _in_order(places):
            place = place + (place >= taken).cast("long")
        places.append(place)
    return places


def _in_order(places: list[Column]) -> list[Column]:
    return [F.array_sort(F.array(*places))[k] for k in range(len(places))] if len(places) > 1 else places


def tree_roots(classes: DataFrame, trees: int, seed: int) -> DataFrame:
    """(node, class): each class in the root of its token of each tree, where others are too."""
    roots = [F.xxhash64(F.lit(seed), F.lit(t), _token(F.lit(place))) for t, place in enumerate(root_places(trees, seed))]
    rows = classes.select("class", "n_shingles", F.explode(F.array(*roots)).alias("node"))
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n_classes")).filter("n_classes > 1").select("node")
    return settled(rows.join(sizes, "node"), "tree-roots")


def open_nodes(rows: DataFrame) -> DataFrame:
    """``rows`` (node, class, component) of nodes with more than one component, with the rows of their node and its first class."""
    sizes = rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_classes"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("class").alias("first"),
    )
    return rows.join(sizes.filter("lo <> hi").select("node", "n_classes", "first"), "node")


def path_ends(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Small and still large nodes at the ends of paths from ``rows`` (node, class, component): (node, class, component, n_classes).

    ``known`` has the signature of each class.
    """
    ends = []
    for depth in range(DEPTH + 1):
        level = settled(open_nodes(rows), "tree-level")
        large = level.filter(F.col("n_classes") > LEAF)
        if not large.limit(1).count():
            ends.append(level.select("node", "class", "component", "n_classes"))
            break
        signed = large.join(known.select("class", "signature"), "class").join(
            known.select(F.col("class").alias("first"), F.col("signature").alias("left")), "first"
        )
        alike = signed.groupBy("node").agg((F.avg(_agreement("left", "signature")) >= ALIKE * SIGNATURE).alias("alike"))
        level = settled(level.join(alike, "node", "left"), "tree-level")
        branching = level.filter("NOT alike") if depth < DEPTH else None
        ended = level.filter("alike IS NULL OR alike") if depth < DEPTH else level
        ends.append(ended.select("node", "class", "component", "n_classes"))
        if branching is None or not branching.limit(1).count():
            break
        steps = [
            F.xxhash64("node", F.lit(b), *[_token(place) for place in branch_places(F.col("node"), b)]) for b in range(BRANCHES)
        ]
        deeper = branching.select("node", "class", "component").join(known.select("class", "signature"), "class")
        rows = deeper.select("class", "component", F.explode(F.array_distinct(F.array(*steps))).alias("node"))
    every = ends[0]
    for more in ends[1:]:
        every = every.unionByName(more)
    return every.filter(F.col("n_classes") <= LEAF), every.filter(F.col("n_classes") > LEAF)


def _agreement(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def token_shares(sets: DataFrame) -> DataFrame:
    """(class, n_tokens, n_shared): how many tokens a set has, and how many of them another set of ``sets`` has, too."""
    told = sets.select("class", F.explode("tokens").alias("token"))
    common = told.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token")
    shared = told.join(common, "token").groupBy("class").agg(F.count(F.lit(1)).alias("n_shared"))
    return settled(shared.join(sets.select("class", F.size("tokens").cast("long").alias("n_tokens")), "class"), "token-shares")


def _reach(percent: int) -> Column:
    """What a set offers a partner: a pair may be linked if each one's reach is at least ``percent`` times the other's size."""
    return F.col("n_shared") * (100 + percent) - F.col("n_tokens") * percent


def fitting(nodes: DataFrame, percent: int) -> DataFrame:
    """Those rows of ``nodes`` (with token shares) that some row of their node, in another component, may be linked with.

    The intersection of x and y is no greater than the shared tokens of either, and a link
    takes (100 + percent) * intersection >= percent * (|x| + |y|). So x needs a y whose size
    is at most x's reach over ``percent``, and whose reach is at least ``percent`` * |x|; of
    the sets of each size in a node only the two farthest reaches of different components
    count. Nothing that has a link which joins components is lost.
    """
    reaching = nodes.withColumn("reach", _reach(percent))
    of_component = reaching.groupBy("node", "n_tokens", "component").agg(F.max("reach").alias("reach"))
    farthest = Window.partitionBy("node", "n_tokens").orderBy(F.col("reach").desc(), "component")
    two = of_component.withColumn("nth", F.row_number().over(farthest)).filter("nth <= 2")
    sizes = two.groupBy("node").agg(F.collect_list(F.struct("n_tokens", "reach", "component")).alias("sizes"))

    def fits(y: Column) -> Column:
        return (y["component"] != F.col("component")) & (y["n_tokens"] * percent <= F.col("reach")) & (y["reach"] >= F.col("n_tokens") * percent)

    return reaching.join(sizes, "node").filter(F.exists("sizes", fits)).drop("sizes")


def hub_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): the set of each node with the farthest reach, and the sets of other components that it may be linked with.

    In a group of edits of one text this is the set with the fewest edits, which is linked
    with whatever has a link in the group at all, so few sets stay outside its component.
    """
    hubs = rows.groupBy("node").agg(F.max(F.struct("reach", "class", "n_tokens", "component")).alias("hub"))
    met = rows.join(hubs, "node").filter(
        (F.col("hub.component") != F.col("component"))
        & (F.col("hub.n_tokens") * percent <= F.col("reach")) & (F.col("hub.reach") >= F.col("n_tokens") * percent)
    )
    return met.select(F.least("hub.class", "class").alias("a"), F.greatest("hub.class", "class").alias("b")).distinct()


def melted(rows: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """(component, melted): what the components of ``rows`` become by ``links`` between classes, where they change."""
    own = rows.select("class", "component").distinct()
    ends = links.join(own.select(F.col("class").alias("a"), F.col("component").alias("x")), "a")
    ends = ends.join(own.select(F.col("class").alias("b"), F.col("component").alias("y")), "b")
    found = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), label)
    return settled(found.select(F.col("node").alias("component"), F.col("component").alias("melted")).filter("component <> melted"), label)


def sets_of(classes: DataFrame, docs: DataFrame, members: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(class, tokens): the full sets of ``classes``, from the text of one member of each."""
    one_of_each = members.join(classes, "class").groupBy("class").agg(F.min("id").alias("id")).select(F.col("id").alias(id)).distinct()
    # a class may have no other id than null
    found = full_sets(rows_with(docs, one_of_each, id), id, text, words)
    return settled(found.join(classes, "class", "left_semi").dropDuplicates(["class"]), "full-sets", ROWS)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the ``pairs`` (a, b) of classes whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("tokens").alias("right"))
    shared = F.size(F.array_intersect("left", "right")).cast("long")
    union = F.size("left").cast("long") + F.size("right") - shared
    return pairs.join(left, "a").join(right, "b").filter(shared * 100 >= union * percent).select("a", "b")


def first_pairs(roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class of a root with the root's smallest, if their sizes and signatures may fit."""
    first = roots.groupBy("node").agg(F.min(F.struct("class", "n_shingles")).alias("first"))
    n, n_first = F.col("n_shingles"), F.col("first.n_shingles")
    sizes_fit = F.least(n, n_first) * 100 >= F.greatest(n, n_first) * percent
    pairs = roots.join(first, "node").filter((F.col("class") != F.col("first.class")) & sizes_fit)
    pairs = pairs.select(F.col("first.class").alias("a"), F.col("class").alias("b")).distinct()
    left = classes.select(F.col("class").alias("a"), F.col("signature").alias("left"))
    right = classes.select(F.col("class").alias("b"), F.col("signature").alias("right"))
    return pairs.join(left, "a").join(right, "b").filter(_agreement("left", "right") >= least_agreement(percent)).select("a", "b")


def _may_fit(units: DataFrame, percent: int) -> DataFrame:
    """The rows of each unit whose size and signature may fit a row of another component, one of the two of side 0."""
    agree = least_agreement(percent)

    def work(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        keep = np.zeros(len(frame), bool)
        component, side = pd.factorize(frame["component"])[0], frame["side"].to_numpy()
        size, signature = frame["n_shingles"].to_numpy(), np.stack(frame["signature"].to_numpy())
        for lo, hi in zip(bounds, bounds[1:]):
            left = lo + np.flatnonzero(side[lo:hi] == 0)
            a, b = size[left][:, None], size[lo:hi][None, :]
            fit = (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent) & (component[left][:, None] != component[lo:hi][None, :])
            i, j = np.nonzero(fit)
            good = (signature[left[i]] == signature[lo + j]).sum(axis=1) >= agree
            keep[left[i[good]]] = keep[lo + j[good]] = True
        return frame.loc[keep, ["unit", "class", "side", "component"]]

    return map_groups(units, "unit", work, "unit long, class binary, side int, component binary")


def _shared_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of a list of sets with another."""
    sets = [*left, *right]
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    of, shared = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.zeros((len(left), len(right)), np.int64)
    width = max(1, CELLS // len(sets))
    for lo in range(0, len(values), width):
        here = (at >= lo) & (at < lo + width) if width < len(values) else slice(None)
        table = np.zeros((len(sets), min(width, len(values) - lo)), np.float32)
        table[of[here], at[here] - lo] = 1
        shared += (table[: len(left)] @ table[len(left) :].T).astype(np.int64)
    return shared


def _unit_links(units: DataFrame, percent: int) -> DataFrame:
    """(a, b): confirmed links of each unit between components, as few as connect what they connect."""

    def work(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        found: list[tuple[bytes, bytes]] = []
        names, sides, sets = frame["class"].to_numpy(), frame["side"].to_numpy(), frame["tokens"].to_numpy()
        for lo, hi in zip(bounds, bounds[1:]):
            left = lo + np.flatnonzero(sides[lo:hi] == 0)
            if not len(left) or hi - lo < 2:
                continue
            shared = _shared_tokens([sets[i] for i in left], [sets[i] for i in range(lo, hi)])
            sizes = np.array([len(sets[i]) for i in range(lo, hi)])
            linked = shared * 100 >= (sizes[left - lo][:, None] + sizes[None, :] - shared) * percent
            joined = dict(zip(frame["component"].iloc[lo:hi], frame["component"].iloc[lo:hi]))

            def root(x: bytes) -> bytes:
                while joined[x] != x:
                    x = joined[x]
                return x

            own = frame["component"].to_numpy()
            for i, j in np.argwhere(linked):
                x, y = root(own[left[i]]), root(own[lo + j])
                if x != y:
                    joined[max(x, y)] = min(x, y)
                    found.append((names[left[i]], names[lo + j]))
        return pd.DataFrame(found, columns=["a", "b"])

    return map_groups(units, "unit", work, "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 85,
    recall: float = 1 - 1e-6, seed: int = 17,
) -> DataFrame:
    """One row per row of ``docs``: (id, n_shingles, component_id, kept), where ``id`` has its own name.

    Texts are A-Z lower-cased and cut at spaces and tab to carriage return. The set of a
    text with fewer than ``words`` words is its whole sequence; null texts and texts
    without words have no set and are linked with nothing. Two texts are linked if
    100 * intersection >= ``percent`` * union of their full sets (as 64-bit numbers of
    shingles). ``component_id`` is the smallest id reachable over links, ``kept`` tells
    whether it is the row's own. Rows that share an id share its component; a null id
    has the component of its text and is kept only if no other id is in it. Equal
    texts are always linked; a link between different texts is missed with a
    probability of less than 1 - ``recall``, and any other path between the two
    makes up for it. A ``recall`` that the signatures cannot give at a low ``percent`` is refused.
    """
    rows = settled(sketches(docs, id, text, words), "sketches", ROWS)
    members = rows.filter("class IS NOT NULL").select("id", "class")
    classes = settled(
        rows.filter("class IS NOT NULL").groupBy("class").agg(F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    roots = tree_roots(classes, trees_for(percent, recall), seed)
    pairs = settled(first_pairs(roots, classes, percent), "first-pairs")
    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    links = settled(confirmed(pairs, sets_of(ends, docs, members, id, text, words), percent), "links")

    joined = components(links)
    known = classes.join(joined, F.col("class") == F.col("node"), "left").select(
        "class", "n_shingles", "signature", F.coalesce("component", "class").alias("component")
    )
    known = settled(known, "known-classes")
    placed = settled(open_nodes(roots.select("node", "class").join(known.select("class", "component"), "class")), "open-roots")
    crowded = placed.filter(F.col("n_classes") > LEAF).select("node", "class", "component")
    crowded_sets = sets_of(crowded.select("class").distinct(), docs, members, id, text, words)
    shared = crowded.join(token_shares(crowded_sets), "class")
    able = settled(fitting(shared, percent), "fitting")
    hub_links = settled(confirmed(hub_pairs(able, percent), crowded_sets, percent), "hub-links")
    changed = melted(able, hub_links, "melted")

    def now(of: DataFrame) -> DataFrame:
        return of.join(changed, "component", "left").withColumn("component", F.coalesce("melted", "component")).drop("melted")

    still_able = fitting(now(able).drop("reach"), percent).select("node", "class", "component")
    small, large = path_ends(still_able, known)
    few = placed.filter(F.col("n_classes") <= LEAF).select("node", "class").unionByName(small.select("node", "class"))
    units = few.select(F.col("node").alias("unit"), "class", F.lit(0).alias("side")).unionByName(_residue_blocks(large))
    open_rows = settled(_may_fit(now(units.join(known, "class")), percent), "open-rows")
    open_sets = sets_of(open_rows.select("class").distinct(), docs, members, id, text, words)
    more_links = settled(_unit_links(open_rows.join(open_sets, "class"), percent), "unit-links", ROWS)
    # rows that share an id are one document: their classes are linked without comparison
    shared = members.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.count_distinct("class").alias("n")).filter("n > 1")
    same_id = members.join(shared, "id").filter("class <> a").select("a", F.col("class").alias("b"))
    final = components(links.unionByName(hub_links).unionByName(more_links).unionByName(same_id))

    smallest = members.groupBy("class").agg(F.min("id").alias("id"))
    placed = smallest.join(final, F.col("class") == F.col("node"), "left").select("class", "id", F.coalesce("component", "class").alias("component"))
    of_component = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = placed.join(of_component, "component").select("class", "component_id")
    found = rows.select("id", "n_shingles", "class").join(of_class, "class", "left")
    component_id = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id), "n_shingles", component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept")
    )


def _residue_blocks(nodes: DataFrame) -> DataFrame:
    """Units of about 2 * BLOCK rows that hold each class outside a node's greatest component with each of the node.

    Side 0 are blocks of the classes outside, side 1 blocks of all classes of the node.
    """
    per_component = nodes.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"))
    greatest = per_component.groupBy("node").agg(F.max(F.struct("n", "component")).alias("greatest"))
    placed = nodes.join(greatest.select("node", F.col("greatest.component").alias("main")), "node")
    outside = placed.filter("component <> main")
    n_outside = outside.groupBy("node").agg(F.count(F.lit(1)).alias("n_outside"))

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("class"), F.ceil(F.col(of) / BLOCK))

    def blocks(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(of) / BLOCK).cast("long") - 1))

    sized = placed.join(n_outside, "node")
    left = sized.filter("component <> main").select("node", "class", block("n_outside").alias("i"), blocks("n_classes").alias("j"), F.lit(0).alias("side"))
    right = sized.select("node", "class", blocks("n_outside").alias("i"), block("n_classes").alias("j"), F.lit(1).alias("side"))
    return left.unionByName(right).select(F.xxhash64("node", "i", "j").alias("unit"), "class", "side")
