"""Licence detection by ordered signature rules.

Texts are A-Z lower-cased. One automaton finds which keywords a text holds; only the
rules of those are tried. A detection that lies within one of higher priority (or of
equal priority and greater length, or the same interval and an earlier rule) is
suppressed. The base phrases are reported wherever their words follow one another and
are never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakewright.llm.license_rules import BASE_RULES, SIGNATURES
from lakewright.llm.shingles import text_bytes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
IN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = re.compile(f"{IN_WORD}+")
IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
BYTES = 4_000_000

DETECTION = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("rule", T.IntegerType()), T.StructField("priority", T.IntegerType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("word", T.IntegerType()),
    T.StructField("base", T.BooleanType()), T.StructField("kept", T.BooleanType()),
])
_ARROW_DETECTION = pa.struct([
    ("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
    ("word", pa.int32()), ("base", pa.bool_()), ("kept", pa.bool_()),
])


def _compiled(pattern: str) -> re.Pattern:
    """Spaces in signatures become anything between words; a signature starts and ends at word bounds."""
    # an optional space within a word, as in "non ?commercial", stays optional
    body = re.sub(r" \?", f"(?:{BETWEEN})?".replace("\\", "\\\\"), pattern.replace(",?", ""))
    body = body.replace(" ", BETWEEN)
    return re.compile(f"(?<!{IN_WORD})(?:{body})(?!{IN_WORD})")


class Rules:
    """The base phrases, then the signatures in their order, and the automaton of their keywords."""

    def __init__(self) -> None:
        import ahocorasick

        lines = [line.split(" | ", 3) for line in SIGNATURES.strip().splitlines()]
        every = BASE_RULES + [(label, int(priority), keywords, pattern) for label, priority, keywords, pattern in lines]
        self.rules = [(label, priority, _compiled(pattern)) for label, priority, _, pattern in every]
        self.by_keyword: dict[str, list[int]] = {}
        for number, (_, _, keywords, _) in enumerate(every):
            for keyword in keywords.split(","):
                self.by_keyword.setdefault(keyword, []).append(number)
        self.automaton = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()

    def detections(self, text: str) -> list[dict]:
        """All detections in a text, in order of their places."""
        text = text.translate(LOWER) if not text.islower() else text
        keywords = {keyword for _, keyword in self.automaton.iter(text)}
        numbers = sorted({n for keyword in keywords for n in self.by_keyword[keyword]})
        found = []
        for n in numbers:
            label, priority, pattern = self.rules[n]
            for m in pattern.finditer(text):
                found.append({"label": label, "rule": n, "priority": priority, "start": m.start(), "end": m.end(), "base": n < len(BASE_RULES)})
        if not found:
            return found
        starts = [m.start() for m in WORD.finditer(text)]
        for d in found:
            d["word"] = bisect_right(starts, d["start"]) - 1
        return suppressed(found)


def suppressed(found: list[dict]) -> list[dict]:
    """``found`` in order of place, each with ``kept``: no detection of greater weight contains it.

    Of equal intervals and priorities the earlier rule counts as the greater.
    """
    found.sort(key=lambda d: (d["start"], -d["end"], -d["priority"], d["rule"]))
    open_ones: list[dict] = []
    for d in found:
        open_ones = [o for o in open_ones if o["end"] > d["start"]]
        d["kept"] = d["base"] or not any(o["end"] >= d["end"] and o["priority"] >= d["priority"] for o in open_ones)
        open_ones.append(d)
    return found


@lru_cache(maxsize=1)
def rules() -> Rules:
    """One set of rules per Python worker."""
    return Rules()


def words_in(column: pa.Array) -> np.ndarray:
    """How many words each text has."""
    flat, bounds = text_bytes(column)
    inside = IS_WORD[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[1:-1]
    edges = edges[edges < len(flat)]
    begins[edges] = inside[edges]
    return np.diff(np.concatenate(([0], np.cumsum(begins)))[bounds])


def scan(docs: DataFrame, text: str = "text", words: str = "n_words", detections: str = "detections") -> DataFrame:
    """``docs`` without ``text``, with its number of words and all detections in it.

    A detection has its label, rule, priority, interval in characters, first word
    (counted from 0), whether it is a base phrase and whether it is kept. Null and empty
    texts have no words and no detections. Rows stay one for one; columns named like an
    added one are replaced. The whole text is scanned at once; patterns have no nested
    repeats, so time grows with the length of the text.
    """
    fields = [f for f in docs.schema.fields if f.name not in (text, words, detections)]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = rules()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = np.array([len(t or "") + 1 for t in column.to_pylist()], np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // BYTES)) + 1), len(sizes)] if len(batch) else []
            for lo, hi in zip(cuts, cuts[1:]):
                part = column.slice(lo, hi - lo)
                found = [known.detections(t) if t else [] for t in part.to_pylist()]
                own = [batch.column(batch.schema.get_field_index(n)).slice(lo, hi - lo) for n in names]
                added = [pa.array(words_in(part).astype(np.int64)), pa.array(found, pa.list_(_ARROW_DETECTION))]
                yield pa.RecordBatch.from_arrays([*own, *added], [*names, words, detections])

    added = [T.StructField(words, T.LongType()), T.StructField(detections, T.ArrayType(DETECTION))]
    return docs.mapInArrow(run, T.StructType([*fields, *added]))
