"""Declared columns of every table, the metric registry, and drift checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MEASURE_KEYS = "source_dataset string, reporter_code string, month_key date, classification_year smallint"

COLUMNS: dict[str, str] = {
    # sources
    "monthly_prices": (
        "source_dataset string, series_id string, period_month date, source_value_text string, "
        "price_usd_per_kg decimal(20,8), source_capture_id string, source_status string"
    ),
    "monthly_trade": (
        "source_dataset string, frequency_code string, reporter_code string, partner_code string, "
        "partner_label string, product_code string, flow_code string, indicator_code string, "
        "period_month date, source_value_text string, source_value decimal(24,4), "
        "source_status string, status_available boolean, classification_code string, "
        "classification_year smallint, source_capture_id string, source_update_time string"
    ),
    "product_groups": (
        "product_code string, product_group string, valid_from_year int, valid_to_year int"
    ),
    "capture_metadata": (
        "source_capture_id string, source_update_text string, source_update_date date, "
        "retrieved_at_utc timestamp, first_seen_capture_at_utc timestamp"
    ),
    # staging
    "stg_benchmark_prices": (
        "source_dataset string, series_id string, period_month date, source_value_text string, "
        "price_usd_per_kg decimal(20,8), source_capture_id string, source_status string"
    ),
    "stg_trade_observations": (
        "source_dataset string, frequency_code string, reporter_code string, partner_code string, "
        "partner_label string, product_code string, product_group string, "
        "classification_code string, classification_year smallint, flow_code string, "
        "indicator_code string, source_value_text string, source_value decimal(24,4), "
        "source_status string, status_available boolean, period_month date, "
        "source_capture_id string, source_update_time string, partner_class string, "
        "is_partner_detail boolean, comparability_segment string, flow_name string, "
        "source_unit string, normalized_unit string, normalized_value decimal(34,4)"
    ),
    # dimensions
    "dim_calendar_month": (
        "month_key date, calendar_year bigint, calendar_quarter bigint, calendar_month bigint, "
        "month_label string"
    ),
    "dim_commodity": "commodity_key string, commodity_name string",
    "dim_trade_partner": (
        "source_dataset string, reporter_code string, partner_code string, partner_label string, "
        "partner_class string, is_partner_detail boolean, label_count bigint, "
        "trade_partner_key string"
    ),
    "dim_trade_product": (
        "product_code string, classification_year int, classification_code string, "
        "product_group string, trade_product_key string, commodity_key string, "
        "has_scope_break boolean, comparability_segment string"
    ),
    # facts
    "monthly_benchmark_prices": (
        "source_dataset string, series_id string, period_month date, "
        "price_usd_per_kg decimal(20,8), source_capture_id string, "
        "change_usd_per_kg decimal(21,8), change_percent double"
    ),
    "fct_benchmark_prices": (
        "source_dataset string, benchmark_series string, month_key date, "
        "price_usd_per_kg decimal(20,8), change_usd_per_kg decimal(21,8), change_percent double, "
        "currency_code string, mass_unit string, source_capture_id string, "
        "benchmark_price_key string, commodity_key string"
    ),
    "fct_trade_observations": (
        "month_key date, source_dataset string, frequency_code string, reporter_code string, "
        "partner_code string, partner_label string, partner_class string, "
        "is_partner_detail boolean, product_code string, product_group string, "
        "classification_code string, classification_year smallint, comparability_segment string, "
        "flow_code string, flow_name string, value_basis string, trade_value_eur decimal(24,4), "
        "net_mass_kg decimal(34,4), unit_value_eur_per_kg double, value_cell_present boolean, "
        "has_numeric_value boolean, value_status string, value_status_available boolean, "
        "quantity_cell_present boolean, has_numeric_mass boolean, quantity_status string, "
        "quantity_status_available boolean, has_paired_measures boolean, "
        "source_capture_id string, source_update_time string, trade_observation_key string, "
        "trade_product_key string, trade_partner_key string, commodity_key string"
    ),
    # marts
    "monthly_benchmark_dynamics": (
        "benchmark_price_key string, source_dataset string, commodity_key string, "
        "benchmark_series string, month_key date, price_usd_per_kg decimal(20,8), "
        "change_usd_per_kg decimal(21,8), change_percent double, currency_code string, "
        "mass_unit string, is_trade_product_identity boolean, source_capture_id string, "
        "benchmark_index double"
    ),
    "monthly_trade_product_metrics": (
        f"{_MEASURE_KEYS}, product_group string, flow_code string, flow_name string, "
        "value_basis string, represented_value_product_count bigint, "
        "observed_value_product_count bigint, represented_mass_product_count bigint, "
        "observed_mass_product_count bigint, paired_product_count bigint, "
        "world_value_eur decimal(38,4), world_net_mass_kg decimal(38,4), "
        "paired_value_eur decimal(38,4), paired_net_mass_kg decimal(38,4), "
        "expected_product_count bigint, contains_scope_break boolean, "
        "universe_expected_product_count bigint, has_complete_value_coverage boolean, "
        "has_complete_mass_coverage boolean, has_complete_paired_coverage boolean, "
        "observed_product_mix_denominator_eur decimal(38,4), "
        "universe_observed_value_product_count bigint, "
        "declared_universe_expected_product_count bigint, coverage_basis string, "
        "observed_unit_value_eur_per_kg double, observed_product_value_share double, "
        "has_complete_product_mix_universe boolean"
    ),
    "monthly_trade_balances": (
        f"{_MEASURE_KEYS}, product_group string, import_value_cif_eur decimal(38,4), "
        "export_value_fob_eur decimal(38,4), import_product_count bigint, "
        "export_product_count bigint, import_product_coverage string, "
        "export_product_coverage string, coverage_basis string, "
        "has_compatible_flow_coverage boolean, trade_balance_eur decimal(38,4)"
    ),
    "monthly_partner_shares": (
        f"{_MEASURE_KEYS}, product_group string, flow_code string, flow_name string, "
        "value_basis string, trade_partner_key string, partner_code string, partner_label string, "
        "partner_value_eur decimal(38,4), observed_product_count bigint, "
        "named_partner_denominator_eur decimal(38,4), concentration_universe string, "
        "named_partner_value_share double, has_positive_named_denominator boolean, "
        "named_partner_rank bigint"
    ),
    "monthly_partner_concentration": (
        f"{_MEASURE_KEYS}, product_group string, flow_code string, "
        "named_partner_value_eur decimal(38,4), largest_named_partner_share double, "
        "named_partner_hhi double, observed_special_value_eur decimal(38,4), "
        "world_value_eur decimal(38,4), reconciliation_residual_eur decimal(38,4), "
        "named_observed_product_count bigint, special_observed_product_count bigint, "
        "world_observed_product_count bigint, named_product_coverage string, "
        "special_product_coverage string, world_product_coverage string, "
        "concentration_universe string, flow_name string, value_basis string, "
        "named_partner_count bigint, has_positive_named_denominator boolean, "
        "observed_special_share_of_world double, residual_share_of_world double, "
        "reconciliation_status string"
    ),
    "metric_dictionary": (
        "metric_name string, model_name string, metric_expression string, metric_unit string, "
        "denominator string, coverage string"
    ),
    # forecast
    "forecast_split_manifest": (
        "origin_month date, evaluation_mode string, minimum_observed_history_months int, "
        "minimum_labeled_training_origins int, issue_at_utc timestamp, split_name string"
    ),
    "forecast_targets": (
        "source_dataset string, series_id string, origin_month date, issue_at_utc timestamp, "
        "split_name string, evaluation_mode string, horizon_months int, target_month date, "
        "target_usd_per_kg decimal(20,8), target_capture_id string, labeled_training_origins int"
    ),
    "forecast_predictions": (
        "run_id string, source_dataset string, series_id string, origin_month date, "
        "target_month date, issue_at_utc timestamp, split_name string, evaluation_mode string, "
        "horizon_months int, model_name string, fit_status string, labeled_training_origins int, "
        "origin_capture_id string, seasonal_input_month date, seasonal_input_capture_id string, "
        "target_capture_id string, prediction_usd_per_kg double, target_usd_per_kg double, "
        "absolute_error double, squared_error double, smape_percent double, "
        "interval_lower double, interval_upper double, interval_covered boolean, "
        "calibration_count bigint"
    ),
    "forecast_metrics": (
        "run_id string, source_dataset string, series_id string, split_name string, "
        "horizon_months int, model_name string, is_selected boolean, origin_count bigint, "
        "prediction_count bigint, scored_count bigint, missing_target_count bigint, "
        "failed_fit_count bigint, mae double, rmse double, smape_percent double, "
        "interval_scored_count bigint, interval_coverage double, mean_interval_width double"
    ),
}

TRADE_KEY = (
    "source_dataset", "frequency_code", "reporter_code", "partner_code",
    "product_code", "flow_code", "indicator_code", "period_month",
)
PRICE_KEY = ("source_dataset", "series_id", "period_month")

# Published metrics as (name, table, column, unit, denominator, coverage).
METRICS = (
    ("benchmark_index", "monthly_benchmark_dynamics", "benchmark_index",
     "index, first usable observation equals 100",
     "first usable price in the captured series",
     "one World Bank series; no coffee-variety or CN8 identity is inferred"),
    ("benchmark_monthly_change_percent", "monthly_benchmark_dynamics", "change_percent",
     "percent", "prior calendar month's usable positive price for the same series",
     "adjacent represented months within one benchmark series"),
    ("named_partner_hhi", "monthly_partner_concentration", "named_partner_hhi",
     "ratio squared, zero to one", "observed numeric value across named partners only",
     "named partners and observed CN8 leaves; special codes and aggregates excluded"),
    ("named_partner_value_share", "monthly_partner_shares", "named_partner_value_share",
     "ratio", "observed numeric value across named partners only",
     "named partners and observed CN8 leaves; special codes and aggregates excluded"),
    ("observed_product_value_share", "monthly_trade_product_metrics",
     "observed_product_value_share", "ratio",
     "WORLD value across observed selected CN8 leaves in the same month and flow",
     "observed annual selected-leaf universe; completeness columns disclose missing leaves"),
    ("observed_trade_unit_value_eur_per_kg", "monthly_trade_product_metrics",
     "observed_unit_value_eur_per_kg", "EUR per kg",
     "positive net mass for the same paired value and mass leaf cells",
     "WORLD rows for observed paired CN8 leaves; not a retail price or margin"),
    ("reconciliation_residual_eur", "monthly_partner_concentration",
     "reconciliation_residual_eur", "EUR",
     "none; WORLD minus observed named and special values per WORLD-covered leaf",
     "WORLD-covered CN8 leaves, with separate coverage signatures for named and special values"),
    ("trade_balance_eur", "monthly_trade_balances", "trade_balance_eur", "EUR",
     "none; export FOB value minus import CIF value",
     "WORLD values with identical observed CN8 leaf sets in both flows; not profit or margin"),
)


def schema(table: str) -> StructType:
    return StructType.fromDDL(COLUMNS[table])


def schema_drift(frame: DataFrame, table: str) -> dict[str, list[str]]:
    """Columns that are undocumented, absent, or of the wrong type."""
    declared = {f.name: f.dataType.simpleString() for f in schema(table).fields}
    actual = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    return {
        "undocumented": sorted(actual.keys() - declared.keys()),
        "absent": sorted(declared.keys() - actual.keys()),
        "wrong_types": sorted(
            c for c in actual.keys() & declared.keys() if actual[c] != declared[c]
        ),
    }


def conform(frame: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared order; raises on any drift."""
    drift = schema_drift(frame, table)
    if any(drift.values()):
        raise ValueError(f"{table}: schema mismatch: {drift}")
    return frame.select(schema(table).fieldNames())


def schema_drift_rows(frames: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """One row per drifting column over many tables; empty means every contract holds."""
    rows = [
        (table, problem, column)
        for table, frame in frames.items()
        for problem, columns in schema_drift(frame, table).items()
        for column in columns
    ]
    return spark.createDataFrame(rows, "table_name string, problem string, column_name string")


def metric_dictionary(spark: SparkSession, metrics=METRICS) -> DataFrame:
    """Metric registry as rows, ordered by name; typed and empty when there are none."""
    return spark.createDataFrame(sorted(metrics), schema("metric_dictionary"))


def metric_population(
    spark: SparkSession, tables: dict[str, DataFrame], metrics=METRICS
) -> DataFrame:
    """The dictionary beside how many rows of its table carry each metric, one scan per table."""
    by_table: dict[str, list[str]] = {}
    for _, table, column, *_ in metrics:
        by_table.setdefault(table, []).append(column)
    counts = None
    for table, columns in sorted(by_table.items()):
        wide = tables[table].agg(
            F.count(F.lit(1)).alias("table_rows"),
            *[F.count(c).alias(c) for c in columns],
        )
        long = wide.unpivot("table_rows", columns, "metric_expression", "published_rows").select(
            F.lit(table).alias("model_name"), "metric_expression", "published_rows", "table_rows"
        )
        counts = long if counts is None else counts.unionByName(long)
    return metric_dictionary(spark, metrics).join(counts, ["model_name", "metric_expression"])
