"""From raw documents to training shards: five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import decontamination, jaccard, language, mixing, token_shards
from monthwise.llm.common import new_path, stored, table

#: A document stays if the mean probability of its language reaches this; documents of one language stay above 0.4 even if short.
LEAST_LANGUAGE_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without text, without letters, or without a clear language."""
    model = language.fit(docs, F.lit(True))
    return language.recognised(docs, model, LEAST_LANGUAGE_SCORE)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group that links of five-word shingles join."""
    return jaccard.distinct_documents(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources reach their target words."""
    return mixing.mixed(docs)


def write_training_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the shards and returns, for every sequence in them, its document and its place."""
    folder = new_path(spark, "shards")
    token_shards.write_shards(docs, folder)
    rows = token_shards.read_shards(spark, folder)
    return rows.select("slot", "shard", "offset", "doc_id", "part", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", remove_near_duplicates),
    ("benchmark_decontamination", remove_leaks),
    ("source_mixing", mix_sources),
    ("token_shards", write_training_shards),
]

ORACLE_SQL: str | None = None  # stages with trained models and hashed sampling have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
