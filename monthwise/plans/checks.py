"""Governance checks over published tables: rows or counts of violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.domain import FoldPlan, TradeDomain
from monthwise.functions.months import index_of, month_index
from monthwise.operators.quality import one_row, stacked, tally
from monthwise.plans.folds import SERIES

TOLERANCE = 1e-12


def staging_semantics(staged: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """Units, normalization, class and status rules of staged cells."""
    value, normal = F.col("source_value"), F.col("normalized_value")
    money = F.col("indicator_code") == domain.value_indicator
    mass = F.col("indicator_code") == domain.mass_indicator
    aggregate = F.col("partner_class") == "aggregate"
    return tally(
        staged,
        {
            "normalized_presence": value.isNull() != normal.isNull(),
            "value_units": money
            & ~(
                (F.col("source_unit") == domain.value_unit)
                & (F.col("normalized_unit") == domain.value_unit)
            ),
            "value_normalization": money & (normal != value),
            "mass_units": mass
            & ~(
                (F.col("source_unit") == domain.mass_source_unit)
                & (F.col("normalized_unit") == domain.mass_unit)
            ),
            "mass_normalization": mass & (normal != value * domain.mass_factor),
            "partner_class": aggregate == F.col("is_partner_detail"),
            "status_without_field": ~F.col("status_available") & F.col("source_status").isNotNull(),
        },
    )


def scope_break_labels(facts: DataFrame, domain: TradeDomain = TradeDomain()) -> DataFrame:
    """Facts of a broken product whose segment contradicts their year."""
    wrong: Column = F.lit(False)
    for gap in domain.scope_breaks:
        expected = F.when(
            F.col("classification_year") <= gap.last_year_before, gap.before
        ).otherwise(gap.after)
        wrong = wrong | (
            (F.col("product_code") == gap.product_code)
            & (F.col("comparability_segment") != expected)
        )
    return facts.where(wrong)


def mapping_shape(mapping: DataFrame, leaves: int, first_year: int, last_year: int) -> DataFrame:
    """One row when the mapping has another number of leaves or other years than declared."""
    return mapping.agg(
        F.count(F.lit(1)).alias("leaf_count"),
        F.min("valid_from_year").alias("first_year"),
        F.max("valid_to_year").alias("last_year"),
    ).where(
        (F.col("leaf_count") != leaves)
        | ~F.col("first_year").eqNullSafe(F.lit(first_year))
        | ~F.col("last_year").eqNullSafe(F.lit(last_year))
    )


def fact_totals(
    staged: DataFrame,
    facts: DataFrame,
    products: DataFrame,
    partners: DataFrame,
    domain: TradeDomain = TradeDomain(),
) -> DataFrame:
    """One row of counts and sums before the pivot, after it, and after the dimension joins.

    Dimension keys are counted first and looked up from the facts, so fan-out and loss show
    in the same single pass that totals the facts.
    """
    def hits(dimension: DataFrame, key: str, name: str) -> DataFrame:
        return (dimension.groupBy(key).agg(F.count(F.lit(1)).alias(name)))

    joined = facts.join(
        hits(products, "trade_product_key", "products"), "trade_product_key", "left"
    ).join(hits(partners, "trade_partner_key", "partners"), "trade_partner_key", "left")
    copies = F.coalesce(F.col("products") * F.col("partners"), F.lit(0)).cast("decimal(10,0)")
    value, mass = F.col("trade_value_eur"), F.col("net_mass_kg")

    def total(column: Column) -> Column:
        return F.sum(column.cast("decimal(28,4)")).cast("decimal(38,4)")

    after = joined.agg(
        F.count(F.lit(1)).alias("fact_count"),
        total(value).alias("fact_value_eur"),
        total(mass).alias("fact_mass_kg"),
        F.coalesce(F.sum(copies), F.lit(0)).cast("long").alias("joined_count"),
        total(F.when(copies > 0, value * copies)).alias("joined_value_eur"),
        total(F.when(copies > 0, mass * copies)).alias("joined_mass_kg"),
    )
    cell = [
        "source_dataset", "reporter_code", "partner_code", "product_code", "flow_code",
        "period_month",
    ]
    before = (
        staged.groupBy(*cell)
        .agg(
            F.sum(
                F.when(F.col("indicator_code") == domain.value_indicator, F.col("source_value"))
            ).alias("v"),
            F.sum(
                F.when(F.col("indicator_code") == domain.mass_indicator, F.col("normalized_value"))
            ).alias("m"),
        )
        .agg(
            F.count(F.lit(1)).alias("expected_fact_count"),
            total(F.col("v")).alias("staged_value_eur"),
            total(F.col("m")).alias("staged_mass_kg"),
        )
    )
    return one_row(before, after)


def fact_preservation(totals: DataFrame) -> DataFrame:
    """The totals row when anything was lost or repeated on the way; null totals compare as unknown."""
    same = F.lit(True)
    for left, right in (
        ("expected_fact_count", "fact_count"), ("fact_count", "joined_count"),
        ("staged_value_eur", "fact_value_eur"), ("fact_value_eur", "joined_value_eur"),
        ("staged_mass_kg", "fact_mass_kg"), ("fact_mass_kg", "joined_mass_kg"),
    ):
        same = same & F.coalesce(F.col(left) == F.col(right), F.lit(True))
    return totals.where(~same)


def metric_invariants(
    facts: DataFrame,
    shares: DataFrame,
    metrics: DataFrame,
    balances: DataFrame,
    concentration: DataFrame,
) -> DataFrame:
    """(check_name, violations) over the trade marts."""
    value, mass, unit = (
        F.col("trade_value_eur").cast("double"), F.col("net_mass_kg"), F.col("unit_value_eur_per_kg")
    )
    unit_values = tally(
        facts,
        {
            "unit_value_without_mass": (mass <= 0) & unit.isNotNull(),
            "unit_value_wrong": (mass > 0)
            & value.isNotNull()
            & (F.abs(unit - value / F.when(mass > 0, mass.cast("double"))) > TOLERANCE),
        },
    )
    named = (
        shares.where("has_positive_named_denominator")
        .groupBy("source_dataset", "reporter_code", "month_key", "product_group", "flow_code")
        .agg(F.sum("named_partner_value_share").alias("total"))
    )
    mix = (
        metrics.where(F.col("observed_product_mix_denominator_eur") > 0)
        .groupBy("source_dataset", "reporter_code", "month_key", "flow_code")
        .agg(F.sum("observed_product_value_share").alias("total"))
    )
    off = F.abs(F.col("total") - 1) > TOLERANCE
    gate = F.col("has_compatible_flow_coverage")
    balance = F.col("trade_balance_eur")
    hhi = F.col("named_partner_hhi")
    return stacked(
        [
            unit_values,
            tally(named, {"named_shares_sum": off}),
            tally(mix, {"product_shares_sum": off}),
            tally(
                balances,
                {
                    "balance_gate": (~gate & balance.isNotNull())
                    | (
                        gate
                        & (
                            balance
                            != F.col("export_value_fob_eur") - F.col("import_value_cif_eur")
                        )
                    )
                },
            ),
            tally(
                concentration,
                {
                    "hhi_without_denominator": ~F.col("has_positive_named_denominator")
                    & hhi.isNotNull(),
                    "hhi_out_of_range": (hhi < 0) | (hhi > 1),
                },
            ),
        ]
    )


def capture_lineage(
    used: Sequence[tuple[DataFrame, Sequence[str]]], registry: DataFrame
) -> DataFrame:
    """Capture ids that tables use and the registry lacks, or that were seen after retrieval.

    ``used`` pairs a table with its capture id columns; all columns of a table are read in
    one pass and reduced to distinct ids before anything is compared.
    """
    ids = stacked(
        [
            frame.select(F.explode(F.array_distinct(F.array(*columns))).alias("capture_id"))
            .where(F.col("capture_id").isNotNull())
            .distinct()
            for frame, columns in used
        ]
    ).distinct()
    known = (registry.select(F.col("source_capture_id").alias("capture_id")))
    late = registry.where(
        F.col("first_seen_capture_at_utc") > F.col("retrieved_at_utc")
    ).select(F.col("source_capture_id").alias("capture_id"))
    return ids.join(known, "capture_id", "left_anti").unionByName(late).distinct()


def fold_invariants(
    manifest: DataFrame, features: DataFrame, targets: DataFrame, plan: FoldPlan = FoldPlan()
) -> DataFrame:
    """(check_name, violations) over the forecast datasets."""
    origin = month_index(F.col("origin_month"))
    expected_split = (
        F.when(origin < index_of(plan.development_start), "training")
        .when(origin < index_of(plan.holdout_start), "development")
        .otherwise("holdout")
    )
    history = F.col(f"observed_history_months_{plan.history_months}")
    lag_wrong = F.lit(False)
    for k in plan.lags:
        lag_wrong = lag_wrong | (month_index(F.col(f"lag_{k}_month")) != origin - k)
    target = month_index(F.col("target_month"))
    return stacked(
        [
            tally(
                manifest,
                {
                    "split_name": F.col("split_name") != expected_split,
                    "evaluation_mode": F.col("evaluation_mode") != plan.mode,
                    "gates": (F.col("minimum_observed_history_months") != plan.history_months)
                    | (F.col("minimum_labeled_training_origins") != plan.labeled_origins),
                    "issue_time": F.col("issue_at_utc")
                    != F.add_months("origin_month", 1).cast("timestamp"),
                },
            ),
            tally(
                features,
                {
                    "lag_month": lag_wrong,
                    "history_gate": F.col("has_minimum_history")
                    != (history == plan.history_months),
                    "history_length": history > plan.history_months,
                },
            ),
            tally(
                targets,
                {
                    "horizon": ~F.col("horizon_months").isin(*plan.horizons),
                    "target_month": (target != origin + F.col("horizon_months"))
                    | (target <= origin),
                    "labeled_origins": F.col("labeled_training_origins") < 0,
                },
            ),
        ]
    )


def result_invariants(
    predictions: DataFrame, metrics: DataFrame, plan: FoldPlan = FoldPlan()
) -> DataFrame:
    """(check_name, violations) over predictions and metrics, and between them."""
    run = ["run_id", *SERIES]
    group = [*run, "split_name", "horizon_months", "model_name"]
    summary = (
        "origin_count", "prediction_count", "scored_count", "missing_target_count",
        "failed_fit_count", "interval_scored_count",
    )
    scored = F.col("absolute_error").isNotNull()
    lower, upper = F.col("interval_lower"), F.col("interval_upper")
    in_summary = (F.col("split_name") == "holdout") | (
        month_index(F.col("target_month")) < index_of(plan.holdout_start)
    )
    detail = (
        predictions.where(in_summary)
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("origin_count"),
            F.count("prediction_usd_per_kg").alias("prediction_count"),
            F.count_if(scored).alias("scored_count"),
            F.count_if(F.col("target_usd_per_kg").isNull()).alias("missing_target_count"),
            F.count_if(F.col("fit_status") == "failed_fit").alias("failed_fit_count"),
            F.count_if(scored & lower.isNotNull()).alias("interval_scored_count"),
        )
    )
    both = metrics.select(*group, F.struct(*summary).alias("stated")).join(
        detail.select(*group, F.struct(*summary).alias("counted")), group, "full"
    )
    duplicates = predictions.groupBy(*run, "origin_month", "horizon_months", "model_name").agg(
        F.count(F.lit(1)).alias("n")
    )
    repeated = metrics.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    chosen = (
        metrics.where(F.col("split_name") == "development")
        .groupBy(*run, "horizon_months")
        .agg(F.count_if("is_selected").alias("n"))
    )
    more = F.col("n") != 1
    return stacked(
        [
            tally(duplicates, {"prediction_key": more}),
            tally(repeated, {"metric_key": more}),
            tally(
                predictions,
                {"bad_interval": (lower > upper) | (lower.isNull() != upper.isNull())},
            ),
            tally(
                metrics,
                {
                    "bad_counts": (F.col("scored_count") > F.col("prediction_count"))
                    | (F.col("prediction_count") > F.col("origin_count"))
                    | (F.col("interval_scored_count") > F.col("scored_count"))
                },
            ),
            tally(chosen, {"selection_count": more}),
            tally(both, {"summary_counts": ~F.col("stated").eqNullSafe(F.col("counted"))}),
        ]
    )
