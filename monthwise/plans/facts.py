"""Price and trade facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import PriceDomain, TradeDomain
from monthwise.functions.months import months_between
from monthwise.functions.numbers import ratio
from monthwise.plans.staging import by_flow


def price_changes(staged: DataFrame) -> DataFrame:
    """monthly_benchmark_prices: change against the preceding calendar month.

    The key holds at most one row per month, so a window partition is as long as the
    calendar.  A gap in the calendar gives no change.
    """
    order = Window.partitionBy("source_dataset", "series_id").orderBy("period_month")
    before = F.lag(F.struct("period_month", "price_usd_per_kg")).over(order)
    price, earlier = F.col("price_usd_per_kg"), F.col("before.price_usd_per_kg")
    adjacent = months_between(F.col("before.period_month"), F.col("period_month")) == 1
    step = price - earlier
    return contracts.conform(
        staged.withColumn("before", before).withColumns(
            {
                "change_usd_per_kg": F.when(adjacent, step),
                "change_percent": F.when(adjacent & (earlier > 0), ratio(step, earlier) * 100),
            }
        ).drop("before", "source_value_text", "source_status"),
        "monthly_benchmark_prices",
    )


def benchmark_prices(changes: DataFrame, domain: PriceDomain = PriceDomain()) -> DataFrame:
    """fct_benchmark_prices."""
    series = F.col("series_id")
    commodity = F.lit(domain.default_commodity)
    for name, key in domain.series_commodity:
        commodity = F.when(series == name, key).otherwise(commodity)
    return contracts.conform(
        changes.select(
            "source_dataset",
            series.alias("benchmark_series"),
            F.col("period_month").alias("month_key"),
            "price_usd_per_kg",
            "change_usd_per_kg",
            "change_percent",
            F.lit(domain.currency).alias("currency_code"),
            F.lit(domain.mass_unit).alias("mass_unit"),
            "source_capture_id",
            F.concat(
                "source_dataset", F.lit(":"), "series_id", F.lit(":"),
                F.col("period_month").cast("string"),
            ).alias("benchmark_price_key"),
            commodity.alias("commodity_key"),
        ),
        "fct_benchmark_prices",
    )


PIVOT_KEYS = (
    "source_dataset", "frequency_code", "reporter_code", "partner_code", "partner_label",
    "partner_class", "is_partner_detail", "product_code", "product_group", "classification_code",
    "classification_year", "comparability_segment", "flow_code", "flow_name", "period_month",
    "source_capture_id", "source_update_time",
)


def paired_measures(staged: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """int_trade_observations_pivoted: value and mass of a cell side by side.

    One grouped pass with map-side combine.  Absent cell, null value and zero stay
    apart through the ``*_cell_present`` and ``has_numeric_*`` flags.
    """
    sides = {
        "value": (domain.value_indicator, "source_value", "trade_value_eur"),
        "quantity": (domain.mass_indicator, "normalized_value", "net_mass_kg"),
    }
    measures = []
    for side, (indicator, column, name) in sides.items():
        hit = F.col("indicator_code") == indicator
        measures += [
            (F.count_if(hit) == 1).alias(f"{side}_cell_present"),
            F.max(F.when(hit, F.col(column))).alias(name),
            F.max(F.when(hit, F.col("source_status"))).alias(f"{side}_status"),
            F.max(F.when(hit, F.col("status_available"))).alias(f"{side}_status_available"),
        ]
    value, mass = F.col("trade_value_eur"), F.col("net_mass_kg")
    return (
        staged.groupBy(*PIVOT_KEYS)
        .agg(*measures)
        .withColumns(
            {
                "has_numeric_value": value.isNotNull(),
                "has_numeric_mass": mass.isNotNull(),
                "has_paired_measures": value.isNotNull() & mass.isNotNull(),
                "unit_value_eur_per_kg": F.when(mass > 0, ratio(value, mass)),
                "value_basis": by_flow(
                    F.col("flow_code"), domain.import_basis, domain.export_basis, domain
                ),
            }
        )
    )


def trade_observations(pivoted: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """fct_trade_observations: the pivoted cell plus its surrogate keys and commodity."""
    rule = domain.commodities
    first_prefix, first_key = rule.prefixes[0]
    return contracts.conform(
        pivoted.withColumns(
            {
                "month_key": F.col("period_month"),
                "trade_observation_key": F.concat_ws(
                    ":",
                    "source_dataset", "reporter_code", "partner_code", "product_code",
                    F.col("classification_year").cast("string"),
                    "flow_code",
                    F.col("period_month").cast("string"),
                ),
                "trade_product_key": F.concat(
                    "product_code", F.lit(":"), F.col("classification_year").cast("string")
                ),
                "trade_partner_key": F.concat(
                    "source_dataset", F.lit(":"), "reporter_code", F.lit(":"), "partner_code"
                ),
                "commodity_key": F.when(
                    F.col("product_group").startswith(first_prefix), first_key
                ).otherwise(rule.fact_default),
            }
        ).drop("period_month"),
        "fct_trade_observations",
    )
