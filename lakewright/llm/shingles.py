"""Word shingles of UTF-8 texts as 64-bit numbers, over flat byte arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(71)
# one random number per byte value, an odd multiplier per place in a shingle, and the base of word hashes
BYTE_CODES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
PLACE_CODES = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: none) and their bounds."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, bounds - bounds[0]


def word_hashes(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word (a run of bytes other than space and tab to carriage return, A-Z lower-cased) and words per text."""
    inside = ~IS_SPACE[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[1:-1]
    edges = edges[edges < len(flat)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    number = np.cumsum(begins) - 1
    place = np.arange(len(flat)) - starts[np.maximum(number, 0)]
    place[~inside] = 0
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(place.max()), BASE))), dtype=np.uint64)
    value = np.where(inside, BYTE_CODES[LOWER[flat]] * powers[place], np.uint64(0))
    hashes = mix(np.add.reduceat(value, starts))
    return hashes, np.diff(np.searchsorted(starts, bounds))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle numbers of each text, one text after the other, and their counts.

    A text with fewer than ``words`` words has its whole sequence as one shingle, one without words none.
    """
    hashes, n_words = word_hashes(*text_bytes(texts))
    ends = np.cumsum(n_words)
    n_shingles = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    total = np.cumsum(n_shingles)
    of = np.repeat(np.arange(len(n_words)), n_shingles)
    at = (ends - n_words)[of] + np.arange(total[-1] if len(total) else 0) - (total - n_shingles)[of]
    value = np.zeros(len(at), np.uint64)
    for k in range(words):
        there = at + k < ends[of]
        value[there] += hashes[(at + k)[there]] * PLACE_CODES[k]
    value = mix(value)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.bincount(of[new], minlength=len(n_words))
