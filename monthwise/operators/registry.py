"""Capture registry and selection history as plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.functions.months import parse_update_label


def merge_captures(known: DataFrame | None, events: DataFrame) -> DataFrame:
    """capture_metadata: latest retrieval, earliest first sighting, parsed update date.

    ``events`` has source_capture_id, retrieved_at_utc and source_update_text.  One grouped
    pass; a capture seen any number of times is one row per task before the shuffle.
    """
    rows = events.select(
        "source_capture_id",
        "source_update_text",
        "retrieved_at_utc",
        F.col("retrieved_at_utc").alias("first_seen_capture_at_utc"),
    )
    if known is not None:
        rows = known.select(rows.columns).unionByName(rows)
    merged = rows.groupBy("source_capture_id").agg(
        F.max(F.struct("retrieved_at_utc", "source_update_text")).alias("latest"),
        F.min("first_seen_capture_at_utc").alias("first_seen_capture_at_utc"),
    )
    return contracts.conform(
        merged.select(
            "source_capture_id",
            F.col("latest.source_update_text"),
            parse_update_label(F.col("latest.source_update_text")).alias("source_update_date"),
            F.col("latest.retrieved_at_utc"),
            "first_seen_capture_at_utc",
        ),
        "capture_metadata",
    )


def append_history(history: DataFrame | None, events: DataFrame, run_id: str) -> DataFrame:
    """History with one more selection run appended; earlier events never change.

    ``events`` has dataset, source_capture_id, retrieved_at_utc and selected_at_utc.  The new
    sequence number follows the largest one, found by a one-row aggregate.
    """
    added = events.withColumn("run_id", F.lit(run_id))
    if history is None:
        return added.withColumn("sequence", F.lit(0).cast("long"))
    following = history.agg(F.coalesce(F.max("sequence") + 1, F.lit(0))).scalar()
    return history.unionByName(added.withColumn("sequence", following.cast("long")))


def first_selected(history: DataFrame) -> DataFrame:
    """When each capture was first selected and first retrieved."""
    return history.groupBy("dataset", "source_capture_id").agg(
        F.min("selected_at_utc").alias("first_selected_at_utc"),
        F.min("retrieved_at_utc").alias("first_seen_capture_at_utc"),
        F.count(F.lit(1)).alias("selection_count"),
    )


def latest_run(history: DataFrame) -> DataFrame:
    """Run id of the newest event."""
    return history.agg(
        F.max_by("run_id", "sequence").alias("run_id"), F.max("sequence").alias("sequence")
    )
