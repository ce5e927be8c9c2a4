"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import quality_classifier, sentencepiece_codec, twins
from lakewright.llm.decontamination import contaminated
from lakewright.llm.embedding_dedup import near_duplicate_vectors
from lakewright.llm.fill_in_middle import fill_in_middle, restore
from lakewright.llm.license_scan import scan
from lakewright.llm.line_dedup import RATIO, drop_boilerplate
from lakewright.llm.minhash_dedup import near_duplicates
from lakewright.llm.sharding import feistel_shards
from lakewright.llm.suffix_dedup import remove_repeats
from lakewright.llm.tables import table
from lakewright.llm.token_alignment import alignment, read_tokenizers
from lakewright.llm.token_counts import count_tokens, read_ranks
from lakewright.llm.url_filter import filter_urls, rule_frame

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
# The rules that the url query is asked to apply.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


KEPT_SCORE = 0.7


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= KEPT_SCORE).cast("int").alias("predicted"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the passage."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every document names or grants."""
    scanned = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: d["kept"])

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    starts = F.transform(base, lambda d: d["word"].cast("long"))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(kept).alias("labels"),
        (F.coalesce(F.array_max(F.transform(kept, lambda d: d["priority"])), F.lit(0)) / 100).alias("score"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into 24 shards whose counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
    )
    placed = feistel_shards(sized, ["doc_id", "text_crc32", "_text"], SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def piece_model() -> bytes:
    """The public model that the coding queries use."""
    import public_tokenizers

    return sentencepiece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy piece counts of every document under a public byte-level vocabulary."""
    import public_tokenizers

    tokens = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), tokens)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoding."""
    decoded = sentencepiece_codec.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), keep_text=False)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate of its source."""
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rule_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of at least 0.98 within their label."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's output and of the text rebuilt from it."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return restore(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that also start elsewhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = remove_repeats(docs, kept_as=lambda kept: F.sha2(kept, 256), name="kept_sha256")
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two public vocabularies."""
    import public_tokenizers

    files = read_tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment(table(spark, sf_dir, "documents").select("doc_id", "text"), *files)


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_decontamination": op2_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_near_dedup": op4_near_dedup,
    "op5_feistel_shards": op5_feistel_shards,
    "op6_token_counts": op6_token_counts,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_token_alignment": op13_token_alignment,
}

SQL: dict[str, str] = {
    "op2_decontamination": twins.DECONTAMINATION,
    "op4_near_dedup": twins.NEAR_DEDUP,
    "op5_feistel_shards": twins.shards(SHARDS),
    "op8_line_dedup": twins.lines(RATIO),
    "op9_url_filter": twins.urls(URL_RULES),
    "op10_embedding_dedup": twins.EMBEDDING_DEDUP,
    "op11_fill_in_middle": twins.FILL_IN_MIDDLE,
    "op12_suffix_dedup": twins.SUFFIX_DEDUP,
}
