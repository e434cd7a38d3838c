"""Checks as DataFrames of violating rows or of violation counts; pass means none.

Counting checks reduce on the map side; none of them moves whole groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations) for columns that must not be null; one pass for all."""
    wide = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "violations")


def repeated_keys(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        frame.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def key_conflicts(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Repeated natural keys: ``duplicate`` when all rows agree, else ``conflicting``.

    Rows agree when the least and the greatest payload are equal: two values per key
    and task, instead of a set of all payloads.
    """
    payload = F.struct(*[c for c in frame.columns if c not in key])
    grouped = frame.groupBy(*key).agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.min(payload) == F.max(payload)).alias("same"),
    )
    return grouped.where(F.col("row_count") > 1).select(
        *key, "row_count", F.when(F.col("same"), "duplicate").otherwise("conflicting").alias("kind")
    )


def unaccepted(frame: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    """Values outside a declared list and how many rows carry each; nulls are not judged."""
    return (
        frame.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(column).alias("column_name"), "value", "violations")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with row counts.

    Keys are reduced before the join, so a hot key crosses the network once per task.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("violations"))
    )
    known = parent.select(F.col(parent_column).alias("key"))
    return used.join(known, "key", "left_anti")


def tally(frame: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """(check_name, violations) for named row predicates; one pass for all of them."""
    wide = frame.agg(
        *[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in tests.items()]
    )
    return wide.unpivot([], list(tests), "check_name", "violations")


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """Failures of several checks in one table."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side, without a join: stacked and reduced per column."""
    wide = frames[0]
    for frame in frames[1:]:
        wide = wide.unionByName(frame, allowMissingColumns=True)
    columns = [c for frame in frames for c in frame.columns]
    return wide.agg(*[F.max(c).alias(c) for c in columns])
