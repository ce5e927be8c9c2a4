"""Greedy longest-match token counts by an automaton that reads each byte once.

The vocabulary is a trie. Where a node has no child for the next byte, greedy matching
has popped some pieces for good and stands at the node of what is left of the string:
both are known per node, so a failure link and the number of popped pieces replace any
looking back. Nothing is built but counts. All distinct words of a batch walk the trie
side by side.

Words are runs of other characters than white space, each read with one space before it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NOWHERE = -1
#: Bytes worked on at a time, distinct words that a task remembers, and the length from which a word walks alone.
BYTES, REMEMBERED, LONG = 1_000_000, 300_000, 256
ADDED = ("n_words", "n_tokens", "n_unknown")


def read_ranks(path: str) -> tuple[bytes, ...]:
    """The tokens of a file of base64 tokens and ranks."""
    return tuple(base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line)


class Automaton:
    """Children, failure links and popped counts of a vocabulary's trie; node 0 is the root."""

    def __init__(self, tokens: tuple[bytes, ...]):
        children: dict[int, int] = {}
        parents, letters, is_token = [NOWHERE], [0], [False]
        for token in tokens:
            node = 0
            for byte in token:
                step = node * 256 + byte
                if step not in children:
                    children[step] = len(parents)
                    parents.append(node)
                    letters.append(byte)
                    is_token.append(False)
                node = children[step]
            if node:
                is_token[node] = True
        depth = [0] * len(parents)
        for v in range(1, len(parents)):
            depth[v] = depth[parents[v]] + 1
        fail, pops = [NOWHERE] * len(parents), [0] * len(parents)
        for v in sorted(range(1, len(parents)), key=depth.__getitem__):
            if is_token[v]:
                fail[v], pops[v] = 0, 1
                continue
            z, popped = fail[parents[v]], pops[parents[v]]
            while z != NOWHERE and z * 256 + letters[v] not in children:
                popped += pops[z]
                z = fail[z]
            if z != NOWHERE:
                fail[v], pops[v] = children[z * 256 + letters[v]], popped
        self.children = children
        steps = sorted(children.items())
        self.steps = np.array([k for k, _ in steps] or [NOWHERE], np.int64)
        self.to = np.array([v for _, v in steps] or [NOWHERE], np.int64)
        self.fail, self.pops = np.array(fail, np.int64), np.array(pops, np.int64)

    def _child(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        key = nodes * 256 + letters
        at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
        return np.where(self.steps[at] == key, self.to[at], NOWHERE)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """The number of pieces of each word; -1 where greedy matching comes to a byte that begins no token."""
        long = np.array([len(w) > LONG for w in words], bool)
        counts = np.zeros(len(words), np.int64)
        short = [w for w, is_long in zip(words, long) if not is_long]
        if short:
            counts[~long] = self._side_by_side(short)
        for i in np.flatnonzero(long):
            counts[i] = self._alone(words[i])
        return counts

    def _alone(self, word: bytes) -> int:
        node, count, children, fail, pops = 0, 0, self.children, self.fail, self.pops
        for byte in word:
            while (step := node * 256 + byte) not in children:
                if fail[node] == NOWHERE:
                    return -1
                count += int(pops[node])
                node = int(fail[node])
            node = children[step]
        while node:
            if fail[node] == NOWHERE:
                return -1
            count += int(pops[node])
            node = int(fail[node])
        return count

    def _side_by_side(self, words: list[bytes]) -> np.ndarray:
        # longest first, so that at each place the words that go on are the first ones
        sizes = np.array([len(w) for w in words])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        flat = np.frombuffer(b"".join(words[i] for i in order), np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        node, count, lost = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        for place in range(int(sizes.max()) + 1):
            going = int(np.searchsorted(-sizes, -place, side="left"))
            # words that ended before this place pop what they stand on, the others read a byte first
            rows = np.arange(going)
            letters = flat[starts[:going] + place]
            while len(rows):
                to = self._child(node[rows], letters[rows])
                met = to != NOWHERE
                node[rows[met]] = to[met]
                rows = rows[~met]
                stuck = self.fail[node[rows]] == NOWHERE
                lost[rows[stuck]], node[rows[stuck]] = True, 0
                rows = rows[~stuck]
                count[rows] += self.pops[node[rows]]
                node[rows] = self.fail[node[rows]]
        rows = np.flatnonzero(node)
        while len(rows):
            stuck = self.fail[node[rows]] == NOWHERE
            lost[rows[stuck]], node[rows[stuck]] = True, 0
            rows = rows[~stuck]
            count[rows] += self.pops[node[rows]]
            node[rows] = self.fail[node[rows]]
            rows = rows[node[rows] != 0]
        count[lost] = -1
        out = np.empty(len(words), np.int64)
        out[order] = count
        return out


@lru_cache(maxsize=2)
def automaton_of(tokens: tuple[bytes, ...]) -> Automaton:
    """One automaton per vocabulary and Python worker."""
    return Automaton(tokens)


class _Numbered(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def count_tokens(docs: DataFrame, tokens: tuple[bytes, ...], text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_tokens`` and ``n_unknown`` (long).

    A word that greedy matching cannot finish counts as one token and as unknown. Null
    and empty texts have none. Rows stay one for one; columns named like an added one
    are replaced. A task holds a megabyte of text at a time, or one text.
    """
    fields = [f for f in docs.schema.fields if f.name not in (text, *ADDED)]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, numbers, lengths = automaton_of(tokens), _Numbered(), np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False) + 1
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // BYTES)) + 1), len(sizes)] if len(batch) else []
            for lo, hi in zip(cuts, cuts[1:]):
                if len(numbers) > REMEMBERED:
                    numbers, lengths = _Numbered(), lengths[:0]
                seen, n_words = [], []
                for t in column.slice(lo, hi - lo).to_pylist():
                    words = t.split() if t else []
                    seen.extend(map(numbers.__getitem__, words))
                    n_words.append(len(words))
                new = list(numbers)[len(lengths) :]
                if new:
                    lengths = np.concatenate((lengths, automaton.lengths([b" " + w.encode("utf-8", "replace") for w in new])))
                found = lengths[np.array(seen, np.int64)]
                bounds = np.concatenate(([0], np.cumsum(n_words)))
                totals = np.concatenate(([0], np.cumsum(np.where(found < 0, 1, found))))[bounds]
                unknown = np.concatenate(([0], np.cumsum(found < 0)))[bounds]
                own = [batch.column(batch.schema.get_field_index(n)).slice(lo, hi - lo) for n in names]
                added = [pa.array(np.array(n_words, np.int64)), pa.array(np.diff(totals)), pa.array(np.diff(unknown))]
                yield pa.RecordBatch.from_arrays([*own, *added], [*names, *ADDED])

    return docs.mapInArrow(run, T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in ADDED)]))
