"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

Vectors are scaled to length one and turned by a random map R with orthonormal columns
into ``bits`` dimensions; the code of o is x = sign(R o) / sqrt(bits). Stored beside it
is f = <x, R o>. For another vector q, <R' x, q> / f is an unbiased estimate of <o, q>
with a standard error of about sqrt((1 - f^2) / f^2 / (bits - 1)). q itself travels as
8-bit numbers with the length of what rounding took, which adds a fixed error. Only pairs
whose upper bound, ``SIGMAS`` errors above the estimate, reaches the threshold are
computed exactly, in double precision.

Which pairs are estimated at all: vectors of one label that agree in all bits of one of
``tables`` slices of their codes. Two vectors at the angle a agree in a bit with
probability 1 - a / pi; the number of slices follows from that and the recall. A crowded
slice is cut into blocks, and each pair of blocks is a unit of work of its own.

Vectors with equal components are one class and cost one row from then on.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.components import components
from lakewright.llm.grouped import map_groups
from lakewright.llm.tables import settled

SLICE, BLOCK, SIGMAS = 16, 256, 6.0


def tables_for(cosine: float, recall: float) -> int:
    """Slices needed for a pair at the threshold to agree in one, but for a probability of 1 - recall."""
    agree = (1 - math.acos(cosine) / math.pi) ** SLICE
    return math.ceil(math.log(1 - recall) / math.log(1 - agree)) if agree < 1 else 1


def rotation(bits: int, dimensions: int, seed: int) -> np.ndarray:
    """A random (bits, dimensions) map; blocks of its rows are orthonormal, as are its columns after scaling."""
    rng = np.random.default_rng(seed)
    blocks = [np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0] for _ in range(-(-bits // dimensions))]
    return np.concatenate(blocks)[:bits] * math.sqrt(dimensions / bits)


def classes_of(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(class_id, label, vector, n): one row per label and distinct usable vector of doubles, under its smallest id."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(values, lambda x: x != 0)
    # adding zero makes minus zero plain zero
    return (
        vectors.filter(usable)
        .select(F.col(id).alias("id"), F.col(label).alias("label"), F.transform(values, lambda x: x + F.lit(0.0)).alias("vector"))
        .groupBy("label", "vector").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"))
        .withColumn("key", F.xxhash64("label", "vector"))
    )


def _scaled(column: pd.Series) -> np.ndarray:
    """Rows of length one; the largest component is brought to one first, so squares stay finite."""
    x = np.stack(column.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(classes: DataFrame, bits: int, seed: int) -> DataFrame:
    """(key, label, dims, code, factor, rough, step, lost): the code, f, the 8-bit vector, its step and the length lost."""

    def run(batches):
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            batch = batch.assign(dims=batch["vector"].map(len))
            for dims, part in batch.groupby("dims"):
                if dims not in maps:
                    maps[dims] = rotation(bits, dims, seed)
                x = _scaled(part["vector"])
                turned = x @ maps[dims].T
                step = np.abs(x).max(axis=1) / 127
                rough = np.rint(x / step[:, None]).astype(np.int8)
                yield pd.DataFrame({
                    "key": part["key"].to_numpy(), "label": part["label"].to_numpy(), "dims": dims,
                    "code": [c.tobytes() for c in np.packbits(turned > 0, axis=1)],
                    "factor": np.abs(turned).sum(axis=1) / math.sqrt(bits),
                    "rough": [r.tobytes() for r in rough], "step": step,
                    "lost": np.linalg.norm(x - rough * step[:, None], axis=1),
                })

    kind = dict(classes.dtypes)["label"]
    return classes.select("key", "label", "vector").mapInPandas(
        run, f"key long, label {kind}, dims int, code binary, factor double, rough binary, step double, lost double"
    )


def _units(coded: DataFrame, tables: int) -> DataFrame:
    """(unit, side, table, ...): rows that share a slice with others; crowded slices as pairs of blocks."""
    width = SLICE // 8
    slices = F.array(*[F.xxhash64("label", "dims", F.lit(t), F.substring("code", t * width + 1, width)) for t in range(tables)])
    rows = coded.select("key", F.posexplode(slices).alias("table", "slice"))
    sizes = rows.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = rows.join(sizes, "slice").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("key", "table"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return dealt.select(
        F.xxhash64("slice", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), side.alias("side"), "table", "key"
    )


def likely_pairs(coded: DataFrame, tables: int, cosine: float, bits: int, seed: int) -> DataFrame:
    """(a, b): pairs of classes whose estimated cosine may reach the threshold, each from the first slice they share."""
    width = SLICE // 8

    def work(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        found_a, found_b = [], []
        key, side = frame["key"].to_numpy(), frame["side"].to_numpy()
        code = np.frombuffer(b"".join(frame["code"]), np.uint8).reshape(len(frame), -1)
        slices = code[:, : tables * width].copy().view(np.uint16)
        sizes, maps = frame["dims"].to_numpy(), {}
        for lo, hi in zip(bounds, bounds[1:]):
            dims = sizes[lo]
            if dims not in maps:
                maps[dims] = rotation(bits, dims, seed)
            unpacked = np.unpackbits(code[lo:hi], axis=1)[:, :bits] * 2.0 - 1.0
            factor, step, lost = (frame[c].to_numpy()[lo:hi] for c in ("factor", "step", "lost"))
            rough = np.frombuffer(b"".join(frame["rough"].iloc[lo:hi]), np.int8).reshape(hi - lo, dims) * step[:, None]
            drawn = unpacked @ maps[dims] / math.sqrt(bits)
            estimate = (drawn @ rough.T) / factor[:, None]
            error = SIGMAS * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / (bits - 1))
            rounding = (np.linalg.norm(drawn, axis=1) / factor)[:, None] * lost[None, :]
            upper = estimate + error[:, None] + rounding
            # a unit with sides 0 and 1 holds two blocks, one with side 2 a block and itself
            own, other = side[lo:hi][:, None], side[lo:hi][None, :]
            names = key[lo:hi]
            ordered = np.where(own == 2, names[:, None] < names[None, :], (own == 0) & (other == 1))
            i, j = np.nonzero(ordered & (upper >= cosine))
            first = np.argmax(slices[lo + i] == slices[lo + j], axis=1) == frame["table"].to_numpy()[lo]
            found_a.append(np.minimum(names[i], names[j])[first])
            found_b.append(np.maximum(names[i], names[j])[first])
        return pd.DataFrame({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    units = _units(coded, tables).join(coded.drop("label"), "key")
    return map_groups(units, "unit", work, "a long, b long").distinct()


def exact_links(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """(a, b): the pairs whose cosine in double precision reaches the threshold."""

    def run(batches):
        for batch in batches:
            for _, part in batch.groupby(batch["left"].map(len)):
                value = (_scaled(part["left"]) * _scaled(part["right"])).sum(axis=1)
                yield part.loc[value >= cosine, ["a", "b"]]

    left = classes.select(F.col("key").alias("a"), F.col("vector").alias("left"))
    right = classes.select(F.col("key").alias("b"), F.col("vector").alias("right"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def near_duplicate_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98,
    recall: float = 1 - 1e-6, seed: int = 29,
) -> DataFrame:
    """One row per row of ``vectors``: (id, n_links, component_id, kept), where ``id`` has its own name.

    Vectors are compared within a label, and only with those of their own length.
    ``n_links`` counts the other rows with a cosine of at least ``cosine`` (copies
    included), ``component_id`` is the smallest id reachable over links. Vectors that
    are null, zero or hold null or non-finite components, and those with a null label,
    link with nothing. A link at the threshold is missed with a probability of less
    than 1 - ``recall``, one above it with less.
    """
    tables = tables_for(cosine, recall)
    bits = max(512, tables * SLICE)
    classes = settled(classes_of(vectors, id, vector, label), "vector-classes")
    coded = settled(codes(classes, bits, seed), "vector-codes")
    pairs = settled(likely_pairs(coded, tables, cosine, bits, seed), "vector-pairs")
    links = settled(exact_links(pairs, classes, cosine), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("key").alias("b"), F.col("n").alias("n_b"))
    linked = both.join(copies, "b").groupBy(F.col("a").alias("key")).agg(F.sum("n_b").alias("n_other"))
    joined = components(links)
    placed = classes.join(joined, F.col("key") == F.col("node"), "left").select(
        "key", "class_id", "label", "vector", "n", F.coalesce("component", "key").alias("component")
    )
    smallest = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    told = placed.join(smallest, "component").join(linked, "key", "left").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"), "component_id",
        (F.col("n") - 1 + F.coalesce("n_other", F.lit(0))).alias("n_links"),
    )
    plain = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(id).alias("_id"), F.col(label).alias("_own_label"), plain.alias("_own_vector"))
    met = (F.col("_own_label") == F.col("_label")) & (F.col("_own_vector") == F.col("_vector"))
    component_id = F.coalesce("component_id", "_id")
    return rows.join(told, met, "left").select(
        F.col("_id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"), F.col("_id").eqNullSafe(component_id).alias("kept"),
    )
