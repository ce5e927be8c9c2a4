"""Suffix arrays by induced sorting and permuted common prefixes, over numpy arrays.

Suffixes are of type S (less than the next one) or L. Leftmost S suffixes cut the string
into substrings; these are sorted by induction, named, and, unless all names differ,
sorted as suffixes of the string of names by recursion. Induction from the sorted
leftmost S suffixes then sorts the rest: a scan puts the L suffix before each sorted one
at the head of its bucket, a scan from the right the S suffixes at the tails. A scan goes
on in blocks up to the first place that is not filled yet: all that a block induces comes
after it, so each block is one array operation.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of ``s`` in order; its last value is 0 and no other is."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    s_type = _types(s)
    leftmost = np.zeros(n, bool)
    leftmost[1:] = s_type[1:] & ~s_type[:-1]
    places = np.flatnonzero(leftmost).astype(np.int32)
    found = _induced(s, s_type, places)
    in_order = found[leftmost[found]]
    names = _names(s, places, in_order)
    if names[-1] + 1 < len(places):
        of = np.empty(n, np.int32)
        of[in_order] = names
        in_order = places[suffix_array(of[places])]
    return _induced(s, s_type, in_order)


def _types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the one that follows; where values are equal, what follows decides."""
    n = len(s)
    steps = np.flatnonzero(s[1:] != s[:-1])
    following = steps[np.minimum(np.searchsorted(steps, np.arange(n - 1)), len(steps) - 1)]
    return np.append(s[following] < s[following + 1], True)


def _names(s: np.ndarray, places: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """The rank of each substring between leftmost S suffixes, both included; equal ones share it."""
    length = np.zeros(len(s), np.int32)
    length[places] = np.append(np.diff(places) + 1, 1)
    sizes = length[in_order]
    same = np.zeros(len(in_order), bool)
    pairs = np.flatnonzero(sizes[1:] == sizes[:-1]) + 1
    if len(pairs):
        n = sizes[pairs]
        begins = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(begins, n)
        equal = s[np.repeat(in_order[pairs], n) + at] == s[np.repeat(in_order[pairs - 1], n) + at]
        same[pairs] = np.logical_and.reduceat(equal, begins)
    return (np.cumsum(~same) - 1).astype(np.int32)


def _dealt(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order of ``values``, the sorted values' ranks among their equals, the distinct values and their counts."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    begins = np.flatnonzero(np.diff(ordered, prepend=-1))
    counts = np.diff(np.append(begins, len(ordered)))
    return order, np.arange(len(ordered)) - np.repeat(begins, counts), ordered[begins], counts


def _induced(s: np.ndarray, s_type: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes, sorted by induction from the ``leftmost`` S suffixes in this order."""
    n, sigma = len(s), int(s.max()) + 1
    ends = np.cumsum(np.bincount(s, minlength=sigma))
    begins = np.append(0, ends[:-1])
    s_begins = begins + np.bincount(s[~s_type], minlength=sigma)
    found = np.full(n, -1, np.int32)
    order, rank, values, counts = _dealt(s[leftmost])
    found[np.repeat(ends[values] - counts, counts) + rank] = leftmost[order]

    heads, i, bucket = begins.copy(), 0, 0
    while i < n:
        bucket = _next(heads, s_begins, bucket)
        stop = int(heads[bucket]) if bucket < sigma else n
        block = found[i:stop]
        block = block[block > 0] - 1
        block = block[~s_type[block]]
        if len(block):
            order, rank, values, counts = _dealt(s[block])
            found[np.repeat(heads[values], counts) + rank] = block[order]
            heads[values] += counts
        i = stop

    # only the L suffixes and the end of the string are final
    tails = ends.copy()
    found[_runs(s_begins, ends)] = -1
    found[0], tails[0] = n - 1, 0
    i, bucket = n, 0
    from_above, low_from_above = tails[::-1], s_begins[::-1]
    while i > 0:
        bucket = _next(low_from_above, from_above, bucket)
        stop = int(tails[sigma - 1 - bucket]) if bucket < sigma else 0
        block = found[stop:i][::-1]
        block = block[block > 0] - 1
        block = block[s_type[block]]
        if len(block):
            order, rank, values, counts = _dealt(s[block])
            found[np.repeat(tails[values] - 1, counts) - rank] = block[order]
            tails[values] -= counts
        i = stop
    return found


def _next(low: np.ndarray, high: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where ``low`` is less than ``high``, or the length."""
    step = 64
    while at < len(low):
        part = low[at : at + step] < high[at : at + step]
        k = int(part.argmax())
        if part[k]:
            return at + k
        at, step = at + step, step * 4
    return len(low)


def _runs(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - begins
    total = np.cumsum(sizes)
    return np.repeat(begins - (total - sizes), sizes) + np.arange(total[-1])


def common_prefixes(s: np.ndarray, order: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the length of the common prefix of its suffix and of that before it in ``order``, and the latter's place.

    Values up to ``least`` agree with nothing, themselves included. A value is irreducible
    if the values before the two differ; only those are compared, each other one is the value
    before it less one.
    """
    n = len(s)
    before = np.empty(n, np.int32)
    before[order[1:]], before[order[0]] = order[:-1], -1
    length = np.zeros(n, np.int32)
    left = np.arange(-1, n - 1)
    reducible = (left >= 0) & (before > 0) & (s[left] == s[np.maximum(before - 1, 0)]) & (s[left] > least)
    a = np.flatnonzero(~reducible & (before >= 0))
    b, k = before[a], 0
    starts = a
    while len(a):
        same = (s[a + k] == s[b + k]) & (s[a + k] > least)
        length[starts[~same]] = k
        a, b, starts, k = a[same], b[same], starts[same], k + 1
    own = np.maximum.accumulate(np.where(reducible, -1, np.arange(n)))
    return np.where(reducible, length[own] - (np.arange(n) - own), length), before
