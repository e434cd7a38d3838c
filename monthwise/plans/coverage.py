"""What is observed, how old it is and where it came from."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.domain import TradeDomain
from monthwise.functions.months import age_in_months

SERIES_KEY = ("partner_code", "product_code", "flow_code")


def partner_layer(partner: Column, domain: TradeDomain = TradeDomain()) -> Column:
    return (
        F.when(partner == domain.total_partner, "world")
        .when(partner.isin(*domain.aggregate_partners), "aggregate")
        .when(partner.isin(*domain.special_partners), "special")
        .otherwise("detail")
    )


def slice_statistics(cells: DataFrame, by: tuple[str, ...] = ("source_capture_id",)) -> DataFrame:
    """Cell, value, status and zero counts with the observed month range, per slice."""
    value = F.col("source_value")
    month = F.when(value.isNotNull(), F.col("period_month"))
    return cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("represented_cell_count"),
        F.count(value).alias("value_cell_count"),
        F.count("source_status").alias("status_cell_count"),
        F.count_if(value == 0).alias("explicit_zero_count"),
        F.bool_or("status_available").alias("status_available"),
        F.min(month).alias("first_observed_month"),
        F.max(month).alias("last_observed_month"),
    )


def series_coverage(
    cells: DataFrame,
    domain: TradeDomain = TradeDomain(),
    by: tuple[str, ...] = ("source_dataset", "reporter_code"),
) -> DataFrame:
    """Last month with a value, with a quantity, and with both, per partner, product, flow."""
    keys = [*by, *SERIES_KEY]
    numeric = F.col("source_value").isNotNull()
    indicator = F.col("indicator_code")
    months = cells.groupBy(*keys, "period_month").agg(
        F.bool_or(numeric & (indicator == domain.value_indicator)).alias("has_value"),
        F.bool_or(numeric & (indicator == domain.mass_indicator)).alias("has_mass"),
    )
    month = F.col("period_month")
    return months.groupBy(*keys).agg(
        F.max(F.when(F.col("has_value"), month)).alias("last_value_month"),
        F.max(F.when(F.col("has_mass"), month)).alias("last_quantity_month"),
        F.max(F.when(F.col("has_value") & F.col("has_mass"), month)).alias("last_paired_month"),
    )


def price_freshness(prices: DataFrame, now: date) -> DataFrame:
    """Months since the last non-null price of each series."""
    observed = F.when(F.col("price_usd_per_kg").isNotNull(), F.col("period_month"))
    return (
        prices.groupBy("source_dataset", "series_id")
        .agg(F.max(observed).alias("latest_observed"))
        .withColumn("observed_age_months", age_in_months(F.col("latest_observed"), now))
    )


def requested_series(requests: DataFrame) -> DataFrame:
    """Every series a request asks for: its code lists multiplied out.

    ``requests`` has source_dataset, reporter_code and arrays partners, products, flows.
    """
    return requests.select(
        "source_dataset", "reporter_code", "products", "flows",
        F.explode("partners").alias("partner_code"),
    ).select(
        "source_dataset", "reporter_code", "partner_code", "flows",
        F.explode("products").alias("product_code"),
    ).select(
        "source_dataset", "reporter_code", "partner_code", "product_code",
        F.explode("flows").alias("flow_code"),
    ).distinct()


def trade_freshness(
    requests: DataFrame, coverage: DataFrame, now: date, domain: TradeDomain = TradeDomain()
) -> DataFrame:
    """Requested against observed series per product, flow and partner layer.

    Series that were requested and never seen stay in the count: a maximum over returned
    cells alone would hide them.
    """
    keys = ["source_dataset", "reporter_code", *SERIES_KEY]
    group = ["source_dataset", "reporter_code", "product_code", "flow_code", "layer"]
    series = (
        requested_series(requests)
        .join(coverage.select(*keys, "last_paired_month"), keys, "left")
        .withColumn("layer", partner_layer(F.col("partner_code"), domain))
    )
    # Counting by month first lets the count at the latest month come from one more pass
    # over few rows.
    by_month = series.groupBy(*group, "last_paired_month").agg(F.count(F.lit(1)).alias("n"))
    month = F.col("last_paired_month")
    latest = F.max(F.struct(month, "n"))
    return (
        by_month.groupBy(*group)
        .agg(
            F.sum("n").alias("requested_series"),
            F.coalesce(F.sum(F.when(month.isNotNull(), F.col("n"))), F.lit(0)).alias(
                "series_with_paired_observations"
            ),
            F.max(month).alias("latest_paired_month"),
            F.min(month).alias("oldest_series_latest_month"),
            latest.alias("latest"),
        )
        .select(
            *group,
            "requested_series",
            "series_with_paired_observations",
            "latest_paired_month",
            "oldest_series_latest_month",
            F.when(month_known(), F.col("latest.n")).otherwise(F.lit(0)).cast("long").alias(
                "series_at_latest_month"
            ),
            age_in_months(F.col("latest_paired_month"), now).alias("observed_age_months"),
        )
    )


def month_known() -> Column:
    return F.col("latest_paired_month").isNotNull()


def mixed_updates(cells: DataFrame) -> DataFrame:
    """Datasets whose slices carry more than one source update time."""
    return (
        cells.groupBy("source_dataset")
        .agg(
            F.min("source_update_time").alias("first_update_time"),
            F.max("source_update_time").alias("last_update_time"),
        )
        .where(F.col("first_update_time") != F.col("last_update_time"))
    )


def used_captures(facts: dict[str, DataFrame]) -> DataFrame:
    """Distinct (dataset, source_capture_id) over fact tables, with fact counts."""
    parts = None
    for name, frame in facts.items():
        part = frame.groupBy("source_capture_id").agg(F.count(F.lit(1)).alias("fact_count")).select(
            F.lit(name).alias("dataset"), "source_capture_id", "fact_count"
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def provenance(facts: dict[str, DataFrame], registry: DataFrame) -> DataFrame:
    """Each capture behind the facts with its registry entry; ``resolved`` is false if none.

    Facts shrink to their few capture ids before the join.
    """
    known = (
        registry.select(
            "source_capture_id", "source_update_text", "retrieved_at_utc",
            "first_seen_capture_at_utc",
        ).withColumn("resolved", F.lit(True))
    )
    return (
        used_captures(facts)
        .join(known, "source_capture_id", "left")
        .withColumn("resolved", F.coalesce("resolved", F.lit(False)))
    )


def source_versions(provenance_rows: DataFrame) -> DataFrame:
    """Per dataset: captures, distinct updates, retrieval range and the sorted capture ids."""
    return provenance_rows.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("capture_count"),
        F.array_join(F.array_sort(F.collect_list("source_capture_id")), ",").alias(
            "source_capture_ids"
        ),
        F.countDistinct("source_update_text").alias("update_count"),
        F.min("retrieved_at_utc").alias("first_retrieved_at_utc"),
        F.max("retrieved_at_utc").alias("last_retrieved_at_utc"),
    )
