"""Declared reads of Parquet tables and the CSV mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.sources.footers import file_drift


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Parquet with the declared schema; nothing is inferred.

    The footers of the files are compared with the contract first, since a forced schema reads an absent column as
    nulls and hides an additional one; any difference raises.
    """
    drift = file_drift(spark, path, table).collect()  # at most a row per column and type
    if drift:
        found = "; ".join(f"{d.problem} {d.column_name} ({d.found_type}) in {d.files} files, as {d.example_path}" for d in drift)
        raise ValueError(f"{table}: files differ from the contract: {found}")
    return contracts.conform(
        spark.read.schema(contracts.schema(table)).parquet(path), table
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """CSV mapping; codes stay text, so leading zeros survive."""
    return (
        spark.read.schema(contracts.schema("product_groups"))
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Raw capture files as (source_path, source_capture_id, content), id = SHA-256."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("source_path"),
        F.sha2("content", 256).alias("source_capture_id"),
        F.col("content").cast("string").alias("content"),
    )
