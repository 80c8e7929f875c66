"""The registered queries of the operators, on the whole given tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgate.llm import (
    context_mixing,
    decontaminate,
    jaccard_join,
    licenses,
    line_dedup,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    token_records,
    toxicity,
    url_filters,
    whitening,
)

#: Labels that may be broadcast.
BROADCAST_LABELS = 1_000_000
#: Id that ends each encoded document, as the query's contract gives it.
END_ID = 2


def tokenizer_path() -> str:
    """Where the installed vocabulary lies; any other tokenizer file can be given to the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def training(spark: SparkSession, folder: str, label: str, parts: int, which: int) -> DataFrame:
    """(doc_id, text, label) of the labelled rows that are not held out."""
    labels = table(spark, folder, "labels").select("doc_id", F.col(label).alias("label"))
    own = labels.where(F.col("label").isNotNull() & ~quality_classifier.held(F.col("doc_id"), parts, which))
    if own.count() <= BROADCAST_LABELS:  # 16 bytes a row; beyond that Spark shuffles both sides
        own = F.broadcast(own)
    return table(spark, folder, "documents").select("doc_id", "text").join(own, "doc_id")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    grammar = toxicity.learned(training(spark, folder, "toxic", 4, 2))
    scored = toxicity.scored(table(spark, folder, "documents"), grammar)
    held = quality_classifier.held(F.col("doc_id"), 4, 2)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.rules(table(spark, folder, "documents")).select(*columns)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.per_document(table(spark, folder, "documents"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    drawn = mixing.drawn(docs.select("doc_id", "source"), mixing.plan(docs))
    return drawn.select("document.doc_id", "document.source", "epoch", "block", "key", "place")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.contamination(found)


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judged(table(spark, folder, "pages"), url_filters.rule_table(spark))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked(table(spark, folder, "documents"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, folder, "documents")))


def op9_token_records(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_records.encoded(docs, tokenizer_path(), END_ID).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    model = quality_classifier.fit(training(spark, folder, "quality", 3, 1))
    scored = quality_classifier.scored(table(spark, folder, "documents"), model)
    held = quality_classifier.held(F.col("doc_id"), 3, 1)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    held = quality_classifier.held(F.col("doc_id"), 5, 1)
    scored = context_mixing.scored(table(spark, folder, "documents"), ~held)
    first = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", held.alias("held_out"), *first, "n_bytes", "bits_per_byte")


def repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Words of a tenth of the ids (by CRC-32) with a repeating end, as the query's contract gives it."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [*words[:a], *(words[a + k % p] for k in range(len(words) - a))]


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.detected(table(spark, folder, "documents"), prepare=repeated_tail))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(whitening.whitened(table(spark, folder, "embeddings")))


OPERATORS = [
    op1_toxicity,
    op2_quality_rules,
    op3_line_dedup,
    op4_mixing,
    op5_decontamination,
    op6_url_filters,
    op7_jaccard_join,
    op8_license_scan,
    op9_token_records,
    op10_quality_classifier,
    op11_context_mixing,
    op12_periodic_runs,
    op13_whitening,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}

ORACLES: dict[str, str] = {"op6_url_filters": url_filters.ORACLE.strip()}
