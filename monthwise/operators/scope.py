"""Scope replacement: what a new source version replaces, including withdrawals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.functions.months import index_of


@dataclass(frozen=True)
class Scope:
    """An inclusive month interval and, per column, the codes it covers."""

    start: date
    end: date
    keys: Mapping[str, tuple[str, ...]]

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError("replacement bounds must be ordered")


def in_scope(scopes: Iterable[Scope] | None, month: str = "period_month") -> Column:
    """Boolean column, never null: is the row inside any scope?

    ``None`` covers every row and an empty collection covers none.  All bounds are
    literals, so month partitions outside every interval are pruned at the scan.
    """
    if scopes is None:
        return F.lit(True)
    scopes = list(scopes)
    if not scopes:
        return F.lit(False)

    def inside(scope: Scope) -> Column:
        return F.col(month).between(F.lit(scope.start), F.lit(scope.end))

    def either(tests: list[Column]) -> Column:
        return reduce(lambda left, right: left | right, tests)

    full = [
        reduce(
            lambda left, right: left & right,
            [F.col(c).isin(*codes) for c, codes in scope.keys.items()],
            inside(scope),
        )
        for scope in scopes
    ]
    # The months stand alone as well, as a condition that partition pruning can use.
    return (
        F.col(month).isNotNull()
        & either([inside(scope) for scope in scopes])
        & F.coalesce(either(full), F.lit(False))
    )


def replace_rows(
    previous: DataFrame, incoming: DataFrame, scopes: Iterable[Scope], month: str = "period_month"
) -> DataFrame:
    """Drop every previous row inside a scope, then add the incoming rows inside it.

    A merge on keys would keep rows that the new version withdrew.  No shuffle: both
    sides are filters over a scan.
    """
    if previous.schema.simpleString() != incoming.schema.simpleString():
        raise ValueError("incompatible normalized schema")
    scopes = list(scopes)
    kept = previous.where(~in_scope(scopes, month))
    return kept.unionByName(incoming.where(in_scope(scopes, month)))


def touched_months(scopes: Iterable[Scope]) -> list[date]:
    """Month starts that a replacement may change, ascending."""
    months = {
        index
        for scope in scopes
        for index in range(index_of(scope.start), index_of(scope.end) + 1)
    }
    return [date(index // 12, index % 12 + 1, 1) for index in sorted(months)]


def slice_scopes(
    slices: DataFrame, start: date, end: date, products: tuple[str, ...], flows: tuple[str, ...]
) -> DataFrame:
    """Per captured slice, the part of a request that it covers.

    ``slices`` has one row per slice: slice_id, reporter_code, start_month, end_month,
    products array, partners array.  Slices that share nothing with the request drop out.
    """
    covered = F.array_sort(
        F.array_intersect("products", F.array(*[F.lit(p) for p in products]).cast("array<string>"))
    )
    return (
        slices.select(
            "slice_id",
            "reporter_code",
            F.greatest("start_month", F.lit(start)).alias("start_month"),
            F.least("end_month", F.lit(end)).alias("end_month"),
            covered.alias("products"),
            F.array(*[F.lit(f) for f in sorted(flows)]).alias("flows"),
            F.array_sort("partners").alias("partners"),
        )
        .where((F.col("start_month") <= F.col("end_month")) & (F.size("products") > 0))
    )


def requested_pairs(
    spark, start: date, end: date, products: tuple[str, ...], reporters: tuple[str, ...], flows: tuple[str, ...]
) -> DataFrame:
    """Every (reporter, flow, month, product) a request asks for."""
    listed = lambda codes: F.explode(F.array(*[F.lit(c) for c in codes]).cast("array<string>"))
    months = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 month")))
    return (
        spark.range(1)
        .select(listed(reporters).alias("reporter_code"))
        .select("reporter_code", listed(flows).alias("flow_code"))
        .select("*", months.alias("period_month"))
        .select("*", listed(products).alias("product_code"))
    )


def selection_gaps(scoped: DataFrame, requested: DataFrame) -> DataFrame:
    """(reporter, flow, month, product) that are missing, overlapping or unrequested.

    ``scoped`` is the result of :func:`slice_scopes`.  Empty means the captured slices
    cover the request exactly once.
    """
    key = ("reporter_code", "flow_code", "period_month", "product_code")
    months = F.sequence("start_month", "end_month", F.expr("interval 1 month"))
    pairs = (
        scoped.select("reporter_code", "products", "flows", F.explode(months).alias("period_month"))
        .select("reporter_code", "products", "period_month", F.explode("flows").alias("flow_code"))
        .select("reporter_code", "flow_code", "period_month", F.explode("products").alias("product_code"))
        .withColumn("side", F.lit("covered"))
        .unionByName(requested.withColumn("side", F.lit("requested")))
    )
    counts = pairs.groupBy(*key).agg(
        F.count_if(F.col("side") == "covered").alias("covering_slices"),
        F.count_if(F.col("side") == "requested").alias("requests"),
    )
    problem = (
        F.when((F.col("requests") > 0) & (F.col("covering_slices") == 0), "missing")
        .when(F.col("covering_slices") > 1, "overlapping")
        .when(F.col("requests") == 0, "unrequested")
    )
    return counts.withColumn("problem", problem).where(F.col("problem").isNotNull())


def uncovered_months(run_start: date, run_end: date, ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Months of a backfill run that no source range (start_month, end_month) covers, for each value of ``by``."""
    sources = ranges.select(*by).distinct() if by else ranges.sparkSession.range(1)
    months = sources.select(
        *by,
        F.explode(
            F.sequence(F.lit(run_start), F.lit(run_end), F.expr("interval 1 month"))
        ).alias("period_month")
    )
    bounded = ranges.select(
        *by,
        F.greatest("start_month", F.lit(run_start)).alias("a"),
        F.least("end_month", F.lit(run_end)).alias("b"),
    ).where(F.col("a") <= F.col("b"))
    covered = bounded.select(
        *by, F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("period_month")
    ).distinct()
    return months.join(covered, [*by, "period_month"], "left_anti")


def clip_ranges(ranges: DataFrame, run_start: date, run_end: date) -> DataFrame:
    """Each source's range cut to the run; sources outside the run drop out."""
    others = [c for c in ranges.columns if c not in ("start_month", "end_month")]
    return ranges.select(
        *others,
        F.greatest("start_month", F.lit(run_start)).alias("start_month"),
        F.least("end_month", F.lit(run_end)).alias("end_month"),
    ).where(F.col("start_month") <= F.col("end_month"))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, with multiplicity; empty means equal tables.

    One grouped pass over both sides instead of two multiset differences.
    """
    columns = left.columns
    both = left.withColumn("__side", F.lit(1)).unionByName(
        right.select(columns).withColumn("__side", F.lit(-1))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("__side").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


def vintage(rows: DataFrame, capture_ids: Iterable[str]) -> DataFrame:
    """Rows of the pinned captures only; restores an older source version."""
    return rows.where(F.col("source_capture_id").isin(*capture_ids))
