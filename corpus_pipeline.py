"""Training-data pipeline over `documents`: five stages, each written and read again before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusgate.llm import decontaminate, jaccard_join, mixing, quality_rules, queries, token_records
from corpusgate.session import checkpoint_dir

#: Words whose ids a task of the last stage remembers: fewer than alone, as earlier stages left their marks in memory.
REMEMBERED_WORDS = 150_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its budget draws them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of every row, and where each lies: (doc_id, start, n_tokens, ids_crc32)."""
    found = token_records.encoded(docs, queries.tokenizer_path(), queries.END_ID, remembered=REMEMBERED_WORDS)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixture),
    ("token_records", tokens),
]

#: SQL can't express the tokenizer's merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is stored in the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
