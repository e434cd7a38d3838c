"""Wide monthly sheets to long price rows, many files at once.

A sheet row is (source_dataset, source_capture_id, row_no, period_text, one text cell per
series).  Valid cells become ``monthly_prices`` rows; everything that must be rejected is
reported as rows by :func:`sheet_violations` and :func:`header_violations`.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import PriceDomain
from monthwise.functions.months import PERIOD_PATTERN, index_of, parse_period, parse_update_label
from monthwise.functions.numbers import half_even_decimal

FILE = ("source_dataset", "source_capture_id")


def check_bounds(start: date, end: date, domain: PriceDomain = PriceDomain()) -> int:
    """Requested months; raises unless the bounds are ordered month starts within the limit."""
    if start.day != 1 or end.day != 1:
        raise ValueError("month bounds must be the first of a month")
    months = index_of(end) - index_of(start) + 1
    if not 1 <= months <= domain.max_months:
        raise ValueError(f"month range must be ordered and at most {domain.max_months} months")
    return months


def _is_missing(raw: Column, domain: PriceDomain) -> Column:
    return raw.isNull() | (raw == "") | F.trim(raw).isin(*domain.missing_markers)


def _price(raw: Column, domain: PriceDomain) -> Column:
    return F.when(~_is_missing(raw, domain), half_even_decimal(raw, 20, 8, "1000000000000"))


def filled_rows(sheets: DataFrame, cells: Mapping[str, str]) -> DataFrame:
    """Sheet rows that are not blank throughout."""
    return sheets.where(F.coalesce("period_text", *cells).isNotNull())


def parse_sheets(
    sheets: DataFrame,
    cells: Mapping[str, str],
    start: date,
    end: date,
    domain: PriceDomain = PriceDomain(),
) -> DataFrame:
    """monthly_prices of the selected months; ``cells`` maps a cell column to its series.

    No shuffle: one row per cell is unpivoted and typed in place.
    """
    check_bounds(start, end, domain)
    period = parse_period(F.col("period_text"))
    raw = F.nullif(F.col("raw"), F.lit(""))
    series = F.create_map(*[F.lit(v) for pair in cells.items() for v in pair])
    long = (
        filled_rows(sheets, cells)
        .withColumn("period_month", period)
        .where(F.col("period_month").between(F.lit(start), F.lit(end)))
        .unpivot([*FILE, "period_month"], list(cells), "cell", "raw")
    )
    return contracts.conform(
        long.select(
            "source_dataset",
            F.element_at(series, F.col("cell")).alias("series_id"),
            "period_month",
            raw.alias("source_value_text"),
            _price(F.col("raw"), domain).alias("price_usd_per_kg"),
            "source_capture_id",
            F.lit(None).cast("string").alias("source_status"),
        ),
        "monthly_prices",
    )


def sheet_violations(
    sheets: DataFrame,
    cells: Mapping[str, str],
    start: date,
    end: date,
    domain: PriceDomain = PriceDomain(),
) -> DataFrame:
    """(file, period_text, rule, occurrences) of everything that rejects a sheet.

    ``bad_period``: not YYYYMmm; ``duplicate_period``; ``bad_number``: text, formula, NaN or
    out-of-range cell in a selected month.  All rules share one grouped pass, and a period
    text that repeats without end still leaves each task as one row.
    """
    check_bounds(start, end, domain)
    valid = F.coalesce(F.col("period_text").rlike(PERIOD_PATTERN), F.lit(False))
    selected = F.coalesce(
        parse_period(F.col("period_text")).between(F.lit(start), F.lit(end)), F.lit(False)
    )
    bad_cells = sum(
        (
            (~_is_missing(F.col(c), domain) & _price(F.col(c), domain).isNull()).cast("int")
            for c in cells
        ),
        F.lit(0),
    )
    periods = filled_rows(sheets, cells).groupBy(*FILE, "period_text").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(selected, bad_cells).otherwise(0)).alias("bad"),
        F.bool_and(valid).alias("valid"),
    )
    found = F.array(
        F.when(~F.col("valid"), F.struct(F.lit("bad_period").alias("rule"), F.col("rows").alias("n"))),
        F.when(
            F.col("valid") & (F.col("rows") > 1),
            F.struct(F.lit("duplicate_period").alias("rule"), F.col("rows").alias("n")),
        ),
        F.when(F.col("bad") > 0, F.struct(F.lit("bad_number").alias("rule"), F.col("bad").alias("n"))),
    )
    return periods.select(
        *FILE, "period_text", F.explode(F.array_compact(found)).alias("v")
    ).select(*FILE, "period_text", F.col("v.rule").alias("rule"), F.col("v.n").alias("occurrences"))


def header_violations(headers: DataFrame, domain: PriceDomain = PriceDomain()) -> DataFrame:
    """(file, rule) for headers whose labels, units, descriptions or update text changed.

    A header is (source_dataset, source_capture_id, labels array, units array,
    descriptions array, update_text).
    """
    labels = F.array(*[F.lit(label) for label, _ in domain.series_labels])
    described = [_count_prefixed(prefix) == 1 for prefix, _ in domain.description_prefixes]
    units_ok = F.forall("units", lambda unit: unit.eqNullSafe(F.lit(domain.unit_label))) & (
        F.size("units") == len(domain.series_labels)
    )
    rules = {
        "labels_changed": ~F.col("labels").eqNullSafe(labels),
        "units_changed": ~F.coalesce(units_ok, F.lit(False)),
        "missing_update_label": F.coalesce(F.trim("update_text"), F.lit("")) == "",
        "description_mismatch": ~_all(described),
    }
    found = F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()])
    return headers.select(*FILE, F.explode(F.array_compact(found)).alias("rule"))


def _count_prefixed(prefix: str) -> Column:
    """How many descriptions of a header start with a prefix."""
    texts = F.coalesce("descriptions", F.array().cast("array<string>"))
    return F.size(F.filter(texts, lambda text: text.startswith(prefix)))


def _all(tests: list[Column]) -> Column:
    result = F.lit(True)
    for test in tests:
        result = result & test
    return result


def update_dates(headers: DataFrame) -> DataFrame:
    """Update label of each file with its date, null when the label names none."""
    return headers.select(
        *FILE, "update_text", parse_update_label(F.col("update_text")).alias("source_update_date")
    )


def price_coverage(
    prices: DataFrame, start: date, end: date, domain: PriceDomain = PriceDomain()
) -> DataFrame:
    """Per series: requested, represented and missing months, null prices, latest observation."""
    requested = check_bounds(start, end, domain)
    month = F.col("period_month")
    return (
        prices.where(month.between(F.lit(start), F.lit(end)))
        .groupBy("source_dataset", "series_id")
        .agg(
            F.count(F.lit(1)).alias("represented_month_count"),
            F.count_if(F.col("price_usd_per_kg").isNull()).alias("null_price_count"),
            F.max(F.when(F.col("price_usd_per_kg").isNotNull(), month)).alias("latest_observed"),
        )
        .select(
            "source_dataset",
            "series_id",
            F.lit(requested).cast("long").alias("requested_month_count"),
            "represented_month_count",
            (F.lit(requested) - F.col("represented_month_count")).alias("missing_month_count"),
            "null_price_count",
            "latest_observed",
        )
    )
