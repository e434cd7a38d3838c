"""Small result sets for readers, cut from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def observed_ranges(dynamics: DataFrame, by: tuple[str, ...] = ("benchmark_series",)) -> DataFrame:
    """Per series: first and last represented month, last observed month, observed months."""
    month = F.col("month_key")
    observed = F.col("price_usd_per_kg").isNotNull()
    return dynamics.groupBy(*by).agg(
        F.min(month).alias("first_period"),
        F.max(month).alias("latest_requested_period"),
        F.max(F.when(observed, month)).alias("latest_observed_period"),
        F.count_if(observed).alias("observed_months"),
    )


def partial_series(ranges: DataFrame) -> DataFrame:
    """Series whose observations end before their last represented month."""
    return ranges.where(
        F.coalesce(
            F.col("latest_observed_period") < F.col("latest_requested_period"), F.lit(True)
        )
    )


def price_rows(dynamics: DataFrame) -> DataFrame:
    """Prices in month and series order, for display."""
    return dynamics.select(
        "month_key", "source_dataset", "benchmark_series", "price_usd_per_kg", "source_capture_id"
    ).orderBy("month_key", "source_dataset", "benchmark_series")


def product_mix_rows(metrics: DataFrame) -> DataFrame:
    """Product metric rows that carry a share."""
    return metrics.where(
        F.col("world_value_eur").isNotNull() & F.col("observed_product_value_share").isNotNull()
    ).select(
        "source_dataset", "reporter_code", "month_key", "product_group", "flow_name",
        "world_value_eur", "world_net_mass_kg", "observed_unit_value_eur_per_kg",
        "observed_product_value_share", "observed_value_product_count", "expected_product_count",
        "has_complete_value_coverage", "has_complete_product_mix_universe",
    )


def mix_completeness(metrics: DataFrame) -> DataFrame:
    """How many share rows lack a complete product universe, per reporter."""
    return product_mix_rows(metrics).groupBy("source_dataset", "reporter_code").agg(
        F.count(F.lit(1)).alias("mix_rows"),
        F.count_if(~F.col("has_complete_product_mix_universe")).alias("incomplete_mix_rows"),
    )


def valid_balances(balances: DataFrame) -> DataFrame:
    """Balances with matching leaf coverage."""
    return balances.where(
        F.col("has_compatible_flow_coverage") & F.col("trade_balance_eur").isNotNull()
    ).select(
        "source_dataset", "reporter_code", "month_key", "product_group", "import_value_cif_eur",
        "export_value_fob_eur", "has_compatible_flow_coverage", "trade_balance_eur",
    )


def balance_validity(balances: DataFrame) -> DataFrame:
    """Valid balances out of all balances, per reporter."""
    return balances.groupBy("source_dataset", "reporter_code").agg(
        F.count(F.lit(1)).alias("balance_rows"),
        F.count_if(
            F.col("has_compatible_flow_coverage") & F.col("trade_balance_eur").isNotNull()
        ).alias("valid_balance_rows"),
    )


def named_concentration(concentration: DataFrame) -> DataFrame:
    """Concentration rows that have named partners."""
    return concentration.where(F.col("named_partner_count") > 0).select(
        "source_dataset", "reporter_code", "month_key", "product_group", "flow_name",
        "named_partner_count", "named_partner_value_eur", "largest_named_partner_share",
        "named_partner_hhi", "observed_special_value_eur", "world_value_eur",
        "reconciliation_residual_eur", "reconciliation_status",
    )


def score_rows(metrics: DataFrame) -> DataFrame:
    """The score table."""
    return metrics.select(
        "source_dataset", "series_id", "split_name", "horizon_months", "model_name", "is_selected",
        "origin_count", "prediction_count", "scored_count", "mae", "rmse", "smape_percent",
        "interval_scored_count", "interval_coverage", "mean_interval_width",
    )


def run_identity(predictions: DataFrame) -> DataFrame:
    """Runs behind the predictions with their holdout origin and target ranges."""
    holdout = F.col("split_name") == "holdout"
    return predictions.groupBy("run_id", "evaluation_mode").agg(
        F.min(F.when(holdout, F.col("origin_month"))).alias("first_holdout_origin"),
        F.max(F.when(holdout, F.col("origin_month"))).alias("last_holdout_origin"),
        F.min(F.when(holdout, F.col("target_month"))).alias("first_holdout_target"),
        F.max(F.when(holdout, F.col("target_month"))).alias("last_holdout_target"),
    )
