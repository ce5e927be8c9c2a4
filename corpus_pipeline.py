"""A corpus pipeline of the training-data operators: five stages over ``documents``.

Every stage works on all rows that its predecessor kept, which are stored as Parquet
between them. The first four return the columns of ``documents``; other columns of
their input are left out. Texts are null, empty or of any length; an empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import quality_classifier, sentencepiece_codec
from lakewright.llm.decontamination import contaminated
from lakewright.llm.line_dedup import drop_boilerplate
from lakewright.llm.minhash_dedup import near_duplicates
from lakewright.llm.queries import KEPT_SCORE, piece_model
from lakewright.llm.tables import rows_with, settled, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ROW = "_row"
#: Percent of the union of two shingle sets that near copies share, and the recall of a link there.
SIMILAR, SIMILAR_RECALL = 80, 1 - 1e-5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score reaches 0.7; the classifier is fitted on the labelled rows among ``docs``.

    Without rows of both labels to learn from nothing tells documents apart, and all stay.
    """
    classifier = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    if not classifier.informed:
        return docs.select(*COLUMNS)
    scored = quality_classifier.score(docs, classifier, name="_score")
    return scored.filter(F.col("_score") >= KEPT_SCORE).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without their sources' boilerplate lines; ``n_chars`` follows the text."""
    shorter = drop_boilerplate(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return shorter.withColumn("n_chars", n_chars).select(*COLUMNS)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a stored ``ROW``, so that a row that is computed again keeps its number."""
    return settled(docs.select(*COLUMNS).withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered ``rows`` whose number is not in ``gone``."""
    return rows_with(rows, gone.select(ROW), ROW, inside=False).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: texts linked, also through others, by shingle sets that are 80 % alike.

    Of a group the row with the smallest id stays, of rows that share it one of them; a
    null id comes last. Rows are told apart by their number, so repeated rows are copies,
    and rows that share an id or have none are judged by their own texts. Rows without
    words are no copies of each other. A link between two different texts at 80 % is
    missed with a probability below 10^-5.
    """
    rows = numbered(docs)
    found = settled(near_duplicates(rows.select(ROW, "text"), id=ROW, percent=SIMILAR, recall=SIMILAR_RECALL), "near-copies")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    # groups of one need no choice
    groups = found.join(found.filter("NOT kept").select("component_id").distinct(), "component_id", "left_semi").select(ROW, "component_id")
    placed = groups.join(rows.select(ROW, "doc_id"), ROW)
    first = placed.groupBy("component_id").agg(F.min(order).alias("first"))
    gone = placed.join(first, "component_id").filter(F.col("first")[ROW] != F.col(ROW))
    return without(rows, gone)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, each judged by its own text."""
    rows = numbered(docs)
    return without(rows, contaminated(rows.select(ROW, "text"), table(spark, sf_dir, "benchmark"), id=ROW))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the ids of their text and whether decoding them gives the text back."""
    decoded = sentencepiece_codec.round_trip(docs, piece_model())
    return decoded.select(
        "doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicates", near_copies),
    ("benchmark decontamination", benchmarks),
    ("SentencePiece coding", pieces),
]

# The first stage's classifier is no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
