"""Fill-in-middle transformation by displacement scatter, and its inverse by gather.

All texts of a slice lie in one array of bytes. The cuts of every text are found by one
scan; each of its three segments moves as a whole, so the output place of a byte is its
own place plus the shift of its segment. The shifts are written as differences at the
segments' first bytes and summed up, and the bytes are scattered to their places, marks
to theirs. The inverse finds the marks in the outputs and gathers the bytes back with
shifts made in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.llm.batches import column, slices, strings, text_bytes
from lakewright.llm.tables import unused

#: The marks of the output. Fixed values.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
#: Of 100 texts, those that are cut, and of 100 that are cut, those with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
BYTES = 2_000_000

_CODE = np.arange(256)
IS_LETTER = ((_CODE | 32) >= ord("a")) & ((_CODE | 32) <= ord("z")) & (_CODE < 128)
IS_INNER = (_CODE & 0xC0) == 0x80
IS_NAME = np.isin(_CODE, list(b"PSM"))


def draws(id: Column, salt: str) -> Column:
    """The first four 8-digit groups of the hex sha256 of ``salt`` and the decimal ``id``, as numbers."""
    told = F.sha2(F.concat(F.lit(salt), id.cast("string")), 256)
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.conv(F.substr(told, k * 8 + 1, F.lit(8)), 16, 10).cast("long"))


def marks(flat: np.ndarray) -> np.ndarray:
    """Where a mark stands in ``flat``, whatever the text bounds."""
    at = np.flatnonzero(flat[: max(len(flat) - 2, 0)] == PREFIX[0])
    return at[IS_NAME[flat[at + 1]] & (flat[at + 2] == PREFIX[2])]


def shifts(starts: np.ndarray, moved: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` places the shift of the segment that it lies in; ``starts`` are sorted, empty segments have none."""
    differences = np.zeros(n + 1, np.int64)
    np.add.at(differences, starts, np.diff(moved, prepend=0))
    return np.cumsum(differences[:n])


class Cuts:
    """Units, cuts and forms of the texts of a slice."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray, drawn: np.ndarray, known: np.ndarray, rate: int, suffix_first: int):
        self.flat, self.bounds = flat, bounds
        self.begin, self.end = bounds[:-1], bounds[1:]
        first = np.zeros(len(flat) + 1, bool)
        first[self.begin] = True
        first = first[: len(flat)]
        letter = IS_LETTER[flat]
        follows = np.zeros(len(flat), bool)
        follows[1:] = letter[:-1]
        opens = ~IS_INNER[flat]
        units = np.flatnonzero(opens & ~(letter & follows & ~first))
        upto = np.searchsorted(units, bounds)
        self.n = np.diff(upto)
        low, high = np.sort(drawn[:, :2] % (self.n + 1)[:, None], axis=1).T
        places = np.append(units, len(flat))
        self.first_cut = np.where(low == self.n, self.end, places[upto[:-1] + low])
        self.second_cut = np.where(high == self.n, self.end, places[upto[:-1] + high])
        at = marks(flat)
        text_of = np.searchsorted(bounds, at, side="right") - 1
        marked = np.zeros(len(self.n), bool)
        marked[text_of[at + MARK <= self.end[text_of]]] = True
        self.plain = (self.begin == self.end) | marked | (drawn[:, 2] % 100 >= rate) | ~known
        self.suffix_first = ~self.plain & (drawn[:, 3] % 100 < suffix_first)
        chars = np.concatenate(([0], np.cumsum(opens)))
        self.prefix_chars = chars[self.first_cut] - chars[self.begin]
        self.middle_chars = chars[self.second_cut] - chars[self.first_cut]

    def outputs(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all outputs and their bounds."""
        plain, turned = self.plain, self.suffix_first
        prefix, middle, suffix = self.first_cut - self.begin, self.second_cut - self.first_cut, self.end - self.second_cut
        bounds = np.concatenate(([0], np.cumsum(self.end - self.begin + np.where(plain, 0, 3 * MARK))))
        base = bounds[:-1]
        mark_p = np.where(turned, base + MARK + suffix, base)
        mark_s = np.where(turned, base, base + MARK + prefix)
        mark_m = base + 2 * MARK + prefix + suffix
        to_prefix = np.where(plain, base, mark_p + MARK)
        to_middle = np.where(plain, base + prefix, mark_m + MARK)
        to_suffix = np.where(plain, base + prefix + middle, mark_s + MARK)
        starts = np.stack((self.begin, self.first_cut, self.second_cut), axis=1).ravel()
        moved = np.stack((to_prefix, to_middle, to_suffix), axis=1).ravel() - starts
        out = np.empty(bounds[-1], np.uint8)
        out[np.arange(len(self.flat)) + shifts(starts, moved, len(self.flat))] = self.flat
        for at, mark in ((mark_p, PREFIX), (mark_s, SUFFIX), (mark_m, MIDDLE)):
            for k in range(MARK):
                out[at[~plain] + k] = mark[k]
        return out, bounds


def restored_bytes(flat: np.ndarray, bounds: np.ndarray, psm: np.ndarray, spm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, their bounds, and which outputs have the marks of their form."""
    begin, end = bounds[:-1], bounds[1:]
    at = marks(flat)
    text_of = np.searchsorted(bounds, at, side="right") - 1
    inside = (at + MARK <= end[text_of]) & (psm | spm)[text_of]
    at, text_of = at[inside], text_of[inside]
    counts = np.bincount(text_of, minlength=len(begin))
    three = np.flatnonzero(counts == 3)
    order = np.full((len(begin), 3), 0)
    order[three] = at[np.isin(text_of, three)].reshape(-1, 3)
    names = np.zeros((len(begin), 3), np.uint8)
    names[three] = flat[order[three] + 1]
    as_psm = psm & (counts == 3) & (names == np.frombuffer(b"PSM", np.uint8)).all(axis=1) & (order[:, 0] == begin)
    as_spm = spm & (counts == 3) & (names == np.frombuffer(b"SPM", np.uint8)).all(axis=1) & (order[:, 0] == begin)
    cut, good = as_psm | as_spm, as_psm | as_spm | ~(psm | spm)
    one, two, last = (order[:, 1] - begin - MARK), (order[:, 2] - order[:, 1] - MARK), (end - order[:, 2] - MARK)
    whole = np.where(good, end - begin, 0)
    prefix, middle, suffix = np.where(cut, np.where(as_psm, one, two), whole), np.where(cut, last, 0), np.where(cut, np.where(as_psm, two, one), 0)
    from_prefix = np.where(cut, order[:, 0] + MARK, begin)
    from_prefix = np.where(as_spm, order[:, 1] + MARK, from_prefix)
    from_middle, from_suffix = order[:, 2] + MARK, np.where(as_psm, order[:, 1], order[:, 0]) + MARK
    made = np.concatenate(([0], np.cumsum(prefix + middle + suffix)))
    starts = np.stack((made[:-1], made[:-1] + prefix, made[:-1] + prefix + middle), axis=1).ravel()
    moved = np.stack((from_prefix, from_middle, from_suffix), axis=1).ravel() - starts
    return flat[np.arange(made[-1]) + shifts(starts, moved, made[-1])], made, good


def fill_in_middle(
    df: DataFrame, id: str = "doc_id", text: str = "text", output: str = "output", salt: str = "1:",
    rate: int = RATE, suffix_first: int = SUFFIX_FIRST, keep_text: bool = True,
) -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, one row for one.

    A text is cut into ``n`` units, runs of ASCII letters or single other code points.
    Two cuts between units are drawn from the row's ``id``: the prefix ends at the first,
    the middle at the second. ``psm`` outputs are ``<P>`` prefix ``<S>`` suffix ``<M>``
    middle, ``spm`` ones ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, ``plain`` ones the
    text. Null texts count as empty. Empty texts, texts that hold a mark, and rows with a
    null id are plain; their two character counts are null. Rows alike give outputs
    alike. Columns named like the new ones are replaced, all others stay (``text`` only
    with ``keep_text``). A task holds some megabytes of text, or one longer text, at a time.
    """
    drawn, known = unused(df.columns, "_drawn", "_known")
    source = df.withColumns({drawn: draws(F.coalesce(F.col(id), F.lit(0).cast(df.schema[id].dataType)), salt), known: F.col(id).isNotNull()})
    added = [
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField(output, T.StringType()),
    ]
    names = {f.name for f in added}
    # a column that is replaced is still read: it may be the text or the id itself
    kept = [f for f in df.schema.fields if f.name not in names and (keep_text or f.name != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, BYTES):
                flat, bounds = text_bytes(column(part, text))
                numbers = column(part, drawn).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                cuts = Cuts(flat, bounds, numbers, column(part, known).to_numpy(zero_copy_only=False).astype(bool), rate, suffix_first)
                form = np.where(cuts.plain, "plain", np.where(cuts.suffix_first, "spm", "psm"))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column(part, f.name) for f in kept), pa.array(cuts.n), pa.array(form, pa.string()), pa.array(cuts.prefix_chars, mask=cuts.plain),
                        pa.array(cuts.middle_chars, mask=cuts.plain), strings(*cuts.outputs()),
                    ],
                    [*(f.name for f in kept), *(f.name for f in added)],
                )

    return source.mapInArrow(run, T.StructType([*kept, *added]))


def restore(df: DataFrame, output: str = "output", form: str = "form", text: str = "restored") -> DataFrame:
    """``df`` with ``text``, rebuilt from ``output`` and ``form`` alone.

    Null outputs count as empty; a null or unknown form is plain. Null where a ``psm``
    or ``spm`` output does not begin with its first mark and hold each mark once, in the
    form's order. A column named like ``text`` is replaced, all others stay.
    """
    kept = [f for f in df.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, output, BYTES):
                flat, bounds = text_bytes(column(part, output))
                forms = np.array(column(part, form).to_pylist(), object)
                made, made_bounds, good = restored_bytes(flat, bounds, forms == "psm", forms == "spm")
                texts = strings(made, made_bounds)
                if not good.all():
                    texts = pa.array([t if ok else None for t, ok in zip(texts.to_pylist(), good)], pa.string())
                yield pa.RecordBatch.from_arrays([*(column(part, f.name) for f in kept), texts], [*(f.name for f in kept), text])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(text, T.StringType())]))
