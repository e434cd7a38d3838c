"""Order-free descriptions of sets of codes and sets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_list(present: Column, code: Column) -> Column:
    """Comma list of the codes that satisfy a flag, ascending; null when there are none.

    An aggregate.  Feed it one row per code: the array then holds each code once
    and its size is that of the published text.
    """
    joined = F.array_join(F.array_sort(F.collect_list(F.when(present, code))), ",")
    return F.nullif(joined, F.lit(""))


def content_measures(columns: list[str]) -> list[Column]:
    """Aggregates row_count and content_hash over rows, whatever their order.

    Row hashes are added as wide decimals: a bigint sum would overflow under ANSI
    rules and an xor would cancel pairs of equal rows.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in sorted(columns)]).cast("decimal(38,0)")
    total = F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(38,0)"))
    return [
        F.count(F.lit(1)).alias("row_count"),
        total.cast("string").alias("content_hash"),
    ]


def fingerprint(frame: DataFrame, label: str) -> DataFrame:
    """One row (table_name, row_count, content_hash) that ignores row order."""
    return frame.agg(F.lit(label).alias("table_name"), *content_measures(frame.columns))
