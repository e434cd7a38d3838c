"""Session defaults for standalone use and tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "8", memory: str = "8g", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("monthwise")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the cluster's setting; only a local master may do with a folder of our own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and context.getCheckpointDir() is None and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="monthwise-"))
    return named or context.getCheckpointDir()
