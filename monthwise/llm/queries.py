"""Registered queries of the operators. Each applies its operator to the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import (
    conversations, decontamination, jaccard, language, mixing, neighbours, quality, secrets, suffix_dedup, token_shards, url_filter, variants, warc,
)
from monthwise.llm.common import new_path, remainder, table


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    rows = warc.resolved(warc.read_archives(spark, folder))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    part = remainder("doc_id", 4)
    model = language.fit(documents, part != 2)
    return language.predicted(documents.withColumn("held_out", part == 2), model)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "shards")
    token_shards.write_shards(table(spark, sf_dir, "documents"), folder)
    rows = token_shards.read_shards(spark, folder)
    return rows.select("slot", "shard", "offset", "doc_id", "part", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    part = remainder("doc_id", 5)
    model = quality.fit(documents, table(spark, sf_dir, "labels"), part != 0)
    return quality.scored(documents.withColumn("held_out", part == 0), model)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source owns its documents; its documents in one language count as one repository."""
    documents = table(spark, sf_dir, "documents")
    return secrets.digested(secrets.scanned(documents, F.struct("source", "lang"), F.col("source")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mixing, op2_nearest_neighbours, op3_benchmark_decontamination, op4_warc_revisits, op5_language_id,
        op6_url_filter, op7_suffix_dedup, op8_token_shards, op9_quality_classifier, op10_jaccard_join,
        op11_secret_scan, op12_conversation_repair, op13_spelling_variants,
    )
}

ORACLES: dict[str, str] = {
    "op4_warc_revisits": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages
        ), d AS (SELECT page_id, n, sha1(h) AS g FROM p),
        o AS (SELECT g, max(page_id) AS m FROM d WHERE n >= 1000 GROUP BY g)
        SELECT d.page_id, d.n AS payload_bytes, d.g AS payload_digest,
            CASE WHEN o.m IS NOT NULL AND o.m IS DISTINCT FROM d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN o.m IS DISTINCT FROM d.page_id THEN o.m END AS refers_to
        FROM d LEFT JOIN o ON d.g = o.g AND d.n >= 1000
    """,
}
