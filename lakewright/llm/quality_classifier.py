"""A quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Words and runs of punctuation, hashed into ``BUCKETS``, have fixed sparse random index
vectors. A bucket's word vector is its index vector plus the sum of those of its
neighbours in the training texts, each scaled to length one. A document is the mean of
its words' vectors, frequent words weighted down; two markers stand beside words
in capitals and words that repeat the one before. What the network's log odds differ by
from those of the training rows is divided by a temperature, fitted on rows that it was
not trained on, and turned into a probability.

Vectors and network are fitted on at most ``sample`` labelled documents, those with the
smallest hashes of their ids, so what reaches the driver does not grow with the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakewright.llm.tables import settled

BUCKETS, DIMENSIONS, NONZERO, REACH = 16384, 64, 8, 2
CAPITALS, REPEATED = 0, 1
#: Share of all words at which a word counts half, and times that a word was met at which it counts half.
RARE, KNOWN = 0.01, 3
HIDDEN, EPOCHS, BATCH = 32, 60, 128
#: Characters worked on at a time, and distinct words whose buckets a task remembers.
CHARS, REMEMBERED = 100_000, 20_000
TOKEN = re.compile(r"\w+|[^\w\s]+")


def index_vectors(seed: int) -> np.ndarray:
    """A sparse vector of ones and minus ones per bucket."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    vectors[np.arange(BUCKETS)[:, None], places] = rng.choice([-1, 1], (BUCKETS, NONZERO))
    return vectors


class _Words(dict):
    """Numbers of words with the bucket of each and whether it is in capitals."""

    def __init__(self) -> None:
        self.buckets: list[int] = []
        self.capitals: list[bool] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.buckets.append(2 + zlib.crc32(word.lower().encode("utf-8", "replace")) % (BUCKETS - 2))
        self.capitals.append(len(word) > 1 and word.isupper())
        return number


def _bucketed(texts: list[str | None], words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the tokens and markers of all texts, and how many each text has."""
    if len(words) > REMEMBERED:
        words.__init__()
        words.clear()
    seen, counts = [], []
    for text in texts:
        found = TOKEN.findall(text) if text else []
        seen.extend(map(words.__getitem__, found))
        counts.append(len(found))
    at, counts = np.array(seen, np.int64), np.array(counts, np.int64)
    if not len(at):
        return at, counts
    of = np.repeat(np.arange(len(counts)), counts)
    capital = np.array(words.capitals)[at]
    same = np.concatenate(([False], (at[1:] == at[:-1]) & (of[1:] == of[:-1])))
    # each token, then the markers that hold for it
    shown = np.stack((np.ones(len(at), bool), capital, same), axis=1)
    values = np.stack((np.array(words.buckets)[at], np.full(len(at), CAPITALS), np.full(len(at), REPEATED)), axis=1)
    return values[shown], np.bincount(np.repeat(of, shown.sum(axis=1)), minlength=len(counts))


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes + 1) // CHARS)) + 1), len(sizes)]
    yield from zip(cuts, cuts[1:])


def _pooled(buckets: np.ndarray, counts: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The mean vector of each text; zero without tokens."""
    pooled = np.zeros((len(counts), DIMENSIONS), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        pooled[full] = np.add.reduceat(vectors[buckets], starts, axis=0) / counts[full][:, None]
    return pooled


def _contexts(texts: DataFrame, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the sum of its neighbours' index vectors over ``texts``, and its count.

    Whole numbers, so the sums do not depend on the order in which parts arrive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, words = index_vectors(seed), _Words()
        sums, seen = np.zeros((BUCKETS, DIMENSIONS), np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            column = batch.column(0)
            for lo, hi in _parts(column) if len(batch) else ():
                buckets, counts = _bucketed(column.slice(lo, hi - lo).to_pylist(), words)
                of = np.repeat(np.arange(len(counts)), counts)
                seen += np.bincount(buckets, minlength=BUCKETS)
                for reach in range(1, REACH + 1):
                    inside = of[reach:] == of[:-reach]
                    left, right = buckets[:-reach][inside], buckets[reach:][inside]
                    for a, b in ((left, right), (right, left)):
                        order = np.argsort(a, kind="stable")
                        own, starts = np.unique(a[order], return_index=True)
                        if len(own):
                            sums[own] += np.add.reduceat(index[b[order]], starts, axis=0)
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there.astype(np.int32)), pa.array(seen[there]), pa.array(list(sums[there]), pa.list_(pa.int64()))],
            ["bucket", "seen", "total"],
        )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [group["bucket"].iat[0]], "seen": [group["seen"].sum()], "total": [np.sum(np.stack(group["total"]), axis=0)]})

    parts = texts.mapInArrow(run, "bucket int, seen long, total array<long>")
    # one row per bucket at most
    rows = parts.groupBy("bucket").applyInPandas(add, "bucket int, seen long, total array<long>").toPandas()
    sums, seen = np.zeros((BUCKETS, DIMENSIONS), np.int64), np.zeros(BUCKETS, np.int64)
    if len(rows):
        sums[rows["bucket"]], seen[rows["bucket"]] = np.stack(rows["total"]), rows["seen"]
    return sums, seen


def word_vectors(texts: DataFrame, seed: int) -> np.ndarray:
    """(BUCKETS, DIMENSIONS): the weighted word vectors fitted on ``texts``, which ends in few partitions."""
    sums, seen = _contexts(texts, seed)
    vectors = index_vectors(seed) / np.sqrt(NONZERO) + sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    share = seen / max(seen.sum(), 1)
    # a word that was met once or never tells little or nothing, and its random vector would drown the others
    known = seen / (seen + KNOWN)
    return (vectors * (known * RARE / (RARE + share))[:, None]).astype(np.float32)


@dataclass
class Network:
    """Pooled vectors to the log odds of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    prior: float = 0.0
    temperature: float = 1.0

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.mean) / self.scale
        return np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.prior + (self.logits(pooled) - self.prior) / self.temperature, -40, 40)))


def constant_network(labels: np.ndarray) -> Network:
    """The share of label 1, a half without labels; for rows of one label only."""
    odds = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    zero = np.zeros(DIMENSIONS)
    return Network(zero, zero + 1, np.zeros((DIMENSIONS, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(odds))


def train(pooled: np.ndarray, labels: np.ndarray, seed: int) -> Network:
    """Two layers by Adam on the log loss with weight decay."""
    rng = np.random.default_rng(seed)
    mean, scale = pooled.mean(axis=0), pooled.std(axis=0) + 1e-6
    x, y = ((pooled - mean) / scale).astype(np.float64), labels.astype(np.float64)
    weights = [
        rng.normal(0, np.sqrt(2 / DIMENSIONS), (DIMENSIONS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1),
    ]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(x))
        for lo in range(0, len(x), BATCH):
            rows, step = order[lo : lo + BATCH], step + 1
            h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            error = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (h > 0)
            slopes = [x[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), h.T @ error + 1e-4 * weights[2], np.array([error.sum()])]
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    return Network(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]), prior)


def fitted_temperature(logits: np.ndarray, labels: np.ndarray, prior: float) -> float:
    """The temperature with the least log loss, by a scan of its logarithm."""
    temperatures = np.exp(np.linspace(0, np.log(20), 120))
    odds = prior + (logits - prior)[None, :] / temperatures[:, None]
    z = np.where(labels == 1, odds, -odds)
    return float(temperatures[np.argmin(np.logaddexp(0, -z).mean(axis=1))])


@dataclass
class Classifier:
    """Word vectors and network; ``informed`` if rows of both labels were learnt from."""

    vectors: np.ndarray
    network: Network
    informed: bool = True


def held_out(id: Column) -> Column:
    """Rows that are never learnt from: the checksum of the id's text leaves 2 by 4. Null ids are not held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = 8000, seed: int = 5,
) -> Classifier:
    """Learns from at most ``sample`` labelled rows that are not held out.

    Several labels of one id count by their majority, ties as 1; null labels and null
    ids are passed over. A fifth of the rows fit the temperature only, and if these
    have one label only it is 1. Without both labels the score is the share of label 1.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(F.col(id)))
        .groupBy(F.col(id).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
        .withColumn("_order", F.xxhash64("_id", F.lit(seed)))
        .orderBy("_order", "_id").limit(sample)
    )
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(known, "_id")
    # ids may repeat in the documents, so the bound is set again
    rows = settled(rows.withColumn("_text", F.xxhash64("text")).orderBy("_order", "_id", "_text").limit(sample).repartition(8, "_id"), "labelled")
    vectors = word_vectors(rows.select("text"), seed)
    learnt = _with_pooled(rows.select("_id", "y", "_order", "_text", "text"), vectors, "text").toPandas().sort_values(["_order", "_id", "_text"])
    y = learnt["y"].to_numpy()
    if len(set(y)) < 2:
        return Classifier(vectors, constant_network(y), informed=False)
    x = np.stack(learnt["pooled"])
    kept_back = (learnt["_order"].to_numpy() % 5 == 0) if len(y) >= 50 else np.zeros(len(y), bool)
    if len(set(y[~kept_back])) < 2:
        kept_back[:] = False
    network = train(x[~kept_back], y[~kept_back], seed)
    if len(set(y[kept_back])) == 2:
        network.temperature = fitted_temperature(network.logits(x[kept_back]), y[kept_back], network.prior)
    return Classifier(vectors, network)


def _with_pooled(df: DataFrame, vectors: np.ndarray, text: str) -> DataFrame:
    names = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for lo, hi in _parts(column) if len(batch) else ():
                pooled = _pooled(*_bucketed(column.slice(lo, hi - lo).to_pylist(), words), vectors)
                kept = [batch.column(batch.schema.get_field_index(n)).slice(lo, hi - lo) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(list(pooled), pa.list_(pa.float32()))], [*names, "pooled"])

    return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes if n != text) + ", pooled array<float>")


def score(docs: DataFrame, classifier: Classifier, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``, the probability of label 1, from the whole text alone.

    Null and empty texts are scored as texts without words. Rows stay one for one; a
    column named like ``name`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for lo, hi in _parts(column) if len(batch) else ():
                pooled = _pooled(*_bucketed(column.slice(lo, hi - lo).to_pylist(), words), classifier.vectors)
                scores = pa.array(classifier.network.probabilities(pooled).astype(np.float64))
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo, hi - lo) for f in kept]
                yield pa.RecordBatch.from_arrays([*own, scores], [*(f.name for f in kept), name])

    return docs.mapInArrow(run, StructType([*kept, StructField(name, DoubleType())]))
