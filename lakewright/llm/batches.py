"""Texts of Arrow batches as flat bytes, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakewright.llm.shingles import text_bytes

__all__ = ["column", "gather", "slices", "strings", "text_bytes"]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``most`` bytes of ``text``, or with one longer text. Sizes are read from the offsets."""
    if not len(batch):
        return
    sizes = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(sizes)]):
        yield batch.slice(lo, hi - lo)


def strings(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The texts whose UTF-8 bytes stand between ``bounds`` in ``flat``."""
    offsets = pa.py_buffer(np.ascontiguousarray(bounds, np.int64))
    array = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(flat))])
    return array.cast(pa.string())


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all runs ``starts[i]`` to ``starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
