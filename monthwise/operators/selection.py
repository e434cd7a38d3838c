"""From a selection of captured versions to the scopes that it replaces.

A request names products, product groups or price series and a month interval.  Groups become the leaves of the
mapping, each inside its years of validity; leaves meet the captured slices in a join, and the result is a scope
table (``operators.scope_tables``) that drives a replacement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.operators.scope import selection_gaps
from monthwise.operators.scope_tables import covered_months

TRADE_KEYS = ("reporter_code", "product_code", "flow_code", "partner_code")
PRICE_KEYS = ("source_dataset", "series_id")


def requested_leaves(requests: DataFrame, mapping: DataFrame) -> DataFrame:
    """request_id, reporter_code, flows, product_code and its months, of codes and of groups.

    ``requests``: request_id, reporter_code, start_month, end_month, products array, product_groups array, flows
    array.  A code that a request names counts for the whole interval; a leaf of a named group only for the years in
    which the mapping holds it there.  A leaf reached in both ways has its months once each.
    """
    fixed = ("request_id", "reporter_code", "flows", "start_month", "end_month")
    none = F.array().cast("array<string>")
    named = requests.select(*fixed, F.explode(F.coalesce("products", none)).alias("product_code"))
    groups = requests.select(*fixed, F.explode(F.coalesce("product_groups", none)).alias("product_group"))
    leaves = groups.join(mapping, "product_group").select(
        "request_id", "reporter_code", "flows",
        F.greatest("start_month", F.make_date("valid_from_year", F.lit(1), F.lit(1))).alias("start_month"),
        F.least("end_month", F.make_date("valid_to_year", F.lit(12), F.lit(1))).alias("end_month"),
        "product_code",
    )
    every = named.unionByName(leaves).where(F.col("start_month") <= F.col("end_month"))
    return covered_months(every, "request_id", "reporter_code", "flows", "product_code").distinct()


def unknown_choices(requests: DataFrame, mapping: DataFrame) -> DataFrame:
    """Named products and groups that the mapping does not hold."""
    def absent(column: str, code: str, kind: str) -> DataFrame:
        listed = requests.select("request_id", F.explode(column).alias(code))
        missing = listed.join(mapping.select(code).distinct(), code, "left_anti")
        return missing.select("request_id", F.lit(kind).alias("kind"), F.col(code).alias("choice"))

    return absent("products", "product_code", "product").unionByName(
        absent("product_groups", "product_group", "product_group")
    ).distinct()


def selected_scopes(leaves: DataFrame, slices: DataFrame) -> DataFrame:
    """Scope table of the leaves that captured slices cover, one row per request, slice and month.

    ``slices``: slice_id, reporter_code, start_month, end_month, products array, partners array.  Partners are those
    the slice was captured for, so a partner that vanished from the new version is withdrawn.
    """
    held = slices.select("slice_id", "reporter_code", "start_month", "end_month", F.explode("products").alias("product_code"))
    months = covered_months(held, "slice_id", "reporter_code", "product_code").distinct()
    met = leaves.join(months, ["reporter_code", "product_code", "period_month"])
    products = met.groupBy("request_id", "slice_id", "reporter_code", "flows", "period_month").agg(
        F.array_sort(F.collect_set("product_code")).alias("product_code")
    )
    return products.join(slices.select("slice_id", "partners"), "slice_id").select(
        "request_id", "slice_id",
        F.col("period_month").alias("start_month"), F.col("period_month").alias("end_month"),
        F.array("reporter_code").alias("reporter_code"), "product_code",
        F.col("flows").alias("flow_code"), F.array_sort("partners").alias("partner_code"),
    )


def selection_problems(scopes: DataFrame, leaves: DataFrame) -> DataFrame:
    """(reporter, flow, month, product) asked for but not captured, or captured by several slices of a request.

    A selection with any row here must not replace anything.
    """
    asked = leaves.select("reporter_code", "period_month", "product_code", F.explode("flows").alias("flow_code")).distinct()
    scoped = scopes.select(
        F.col("reporter_code")[0].alias("reporter_code"), "start_month", "end_month",
        F.col("product_code").alias("products"), F.col("flow_code").alias("flows"),
    )
    return selection_gaps(scoped, asked)


def price_scopes(requests: DataFrame) -> DataFrame:
    """Scope table of price requests: request_id, source_dataset, start_month, end_month, series array."""
    return requests.select(
        "request_id", "start_month", "end_month", F.array("source_dataset").alias("source_dataset"),
        F.array_distinct("series").alias("series_id"),
    )


def price_problems(requests: DataFrame, ranges: DataFrame) -> DataFrame:
    """(request, series, month) asked for beyond the captured ranges of the series."""
    asked = covered_months(
        requests.select("request_id", "source_dataset", "start_month", "end_month", F.explode("series").alias("series_id")),
        "request_id", "source_dataset", "series_id",
    )
    held = covered_months(ranges, "source_dataset", "series_id").distinct()
    return asked.join(held, ["source_dataset", "series_id", "period_month"], "left_anti")
