"""Removal of repeated strings against a table of all windows, and the suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.llm import suffix_dedup
from lakewright.llm.queries import QUERIES
from lakewright.llm.suffix_array import common_prefixes, suffix_array
from tests.conftest import SMALL


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    told = [(t or "").encode() for t in texts]
    windows = Counter(t[i : i + length] for t in told for i in range(len(t) - length + 1))
    for t in told:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        yield len(t), sum(gone), len([p for p in bytes(gone).split(b"\0") if p]), bytes(b for b, g in zip(t, gone) if not g)


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_suffix_arrays_equal_sorting(letters):
    rng = np.random.default_rng(letters)
    for n in [*range(40), 300]:
        s = np.append(rng.integers(1, letters + 1, n), 0).astype(np.int32)
        told = s.tolist()
        order = suffix_array(s)
        assert order.tolist() == sorted(range(n + 1), key=lambda i: told[i:])
        prefix, before = common_prefixes(s, order, 1)
        for i, j in zip(order[1:], order):
            k = 0
            while told[i + k] == told[j + k] and told[i + k] > 1:
                k += 1
            assert (prefix[i], before[i]) == (k, j)


def test_least_places():
    rng = np.random.default_rng(7)
    for n, width in [(5, 5), (40, 7), (41, 7), (100, 1), (64, 32)]:
        values = rng.integers(0, 9, n).astype(np.uint64)
        assert suffix_dedup.least_places(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(n - width + 1)]


def test_hashes_tell_strings_apart():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 3, 5000).astype(np.uint8)
    for side in range(2):
        up, down = suffix_dedup.powers(side, 5000)
        assert up.dtype == np.uint64 and (up * down == 1).all() and len(set(up.tolist())) == 5000
        told = suffix_dedup.Hashes(text, 5000).of(side, np.arange(4900), np.arange(4900) + 60)
        assert len(set(told.tolist())) == len({text[i : i + 60].tobytes() for i in range(4900)})


@pytest.mark.parametrize("block", [suffix_dedup.BLOCK, 150])
def test_every_window_is_in_one_snippet_with_its_anchor(block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 59, 60, 61, 700, 0, 1000, 3)] + [b"a" * 500, b"ab" * 300]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    anchor_of, places = {}, []
    for part in suffix_dedup.snippets_of(np.frombuffer(b"".join(texts), np.uint8), bounds, 60):
        for text, start, windows, anchor, d1, d2 in zip(*part):
            for i in range(start, start + windows):
                places.append((text, i))
                assert anchor_of.setdefault(texts[text][i : i + 60], anchor) == anchor
    assert places == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 59)]


def passages(rng):
    def prose(n):
        return "".join(rng.choice("abcdeé \n") for _ in range(n))

    shared = [prose(n) for n in (60, 61, 75, 130, 400)]
    texts = [prose(rng.randrange(80)) + rng.choice(shared) + prose(rng.randrange(80)) + rng.choice([*shared, ""]) for _ in range(120)]
    long = prose(3000)
    texts += [long, long, long[:1500] + "X" + long[1501:], long[200:900], "a" * 500, "ab" * 100, "b" + "a" * 61]
    texts += [None, "", "short", "z" * 59, "z" * 60, "y" * 61, "twice" * 20, *texts[:6]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 3, 0])
def test_equals_all_windows(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    texts = passages(random.Random(9))
    rows = [(k if k % 9 else None, t, k, "x") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lo long, _digest string").repartition(4)
    got = {r.lo: r for r in suffix_dedup.remove_repeats(df, length=60).collect()}
    assert len(got) == len(rows) and all(r["_digest"] == "x" for r in got.values())
    assert [(got[k].n_bytes, got[k].n_removed, got[k].n_spans, bytes(got[k].kept)) for k in range(len(texts))] == list(brute(texts, 60))


def test_empty_table_and_replaced_columns(spark):
    df = spark.createDataFrame([("a" * 300, 1, "b"), (None, 2, None)], "text string, n_bytes int, kept string")
    assert suffix_dedup.remove_repeats(df.filter("false")).count() == 0
    assert {(r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df, name="text").collect()} == {(300, 300, 1), (0, 0, 0)}
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=48)


def test_the_query_equals_all_windows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_suffix_dedup"](spark, SMALL).collect()}
    for d, (n, gone, spans, kept) in zip(docs, brute([d.text for d in docs], 200)):
        assert got[d.doc_id] == (n, gone, spans, hashlib.sha256(kept).hexdigest())


def test_only_snippets_that_share_a_core_are_sorted():
    """Of the snippets of one anchor all that hold a repeated window stay, and of those that share little beside the anchor none."""
    rng, length = np.random.default_rng(9), suffix_dedup.LENGTH
    rest = length - suffix_dedup.ANCHOR
    anchor = rng.integers(97, 123, suffix_dedup.ANCHOR).astype(np.uint8)
    whole = np.frombuffer(anchor.tobytes(), np.uint8)
    hashed = suffix_dedup.Hashes(whole, 64).of(0, np.array([0]), np.array([len(whole)]))[0]
    context = rng.integers(97, 123, (2, rest)).astype(np.uint8)
    texts = []
    for _ in range(60):
        left, right = rng.integers(0, rest + 1, 2)
        # what is shared ends somewhere on each side
        before, after = rng.integers(97, 123, (2, rest)).astype(np.uint8)
        before[rest - left :], after[:right] = context[0][rest - left :], context[1][:right]
        texts.append(np.concatenate((before, anchor, after)).tobytes())
    kept = suffix_dedup.may_repeat(texts, np.full(len(texts), hashed), length)
    holds = np.zeros(len(texts), bool)
    holds[suffix_dedup.repeated_runs(texts, length)[0]] = True
    assert holds.any() and not holds.all() and kept[holds].all() and not kept.all()
    alone = [rng.integers(97, 123, rest).astype(np.uint8).tobytes() + anchor.tobytes() + rng.integers(97, 123, rest).astype(np.uint8).tobytes() for _ in range(9)]
    assert not suffix_dedup.may_repeat(alone, np.full(9, hashed), length).any()


def test_cores_cover_every_place():
    for length, parts in [(49, 8), (55, 8), (200, 8), (200, 1), (201, 300)]:
        rest = length - suffix_dedup.ANCHOR
        told = suffix_dedup.cores(length, parts)
        assert [p for lo, hi, _, _ in told for p in range(lo, hi + 1)] == list(range(rest + 1))
        assert all(left <= p and right <= rest - p for lo, hi, left, right in told for p in (lo, hi))


def test_crowded_snippets_give_few_window_rows(spark, monkeypatch):
    """Many texts with the edge of one passage: parts of their snippets are compared, and not each of their windows."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 20)
    rng, counted = random.Random(4), []

    def prose(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage, own = prose(300), suffix_dedup.counted_ranges
    texts = [prose(250) + passage + prose(250) for _ in range(60)]

    def noted(open_, length):
        counted.append(open_.agg(F.coalesce(F.sum("windows"), F.lit(0)).alias("n")).first()["n"])
        return own(open_, length)

    monkeypatch.setattr(suffix_dedup, "counted_ranges", noted)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect()}
    assert [got[k] for k in range(len(texts))] == list(brute(texts, suffix_dedup.LENGTH))
    # a snippet at an edge of the passage has up to 153 windows, its crowded part 13
    assert sum(counted) <= len(texts) * 2 * 2 * 13
