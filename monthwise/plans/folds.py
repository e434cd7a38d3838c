"""Forecast datasets: split manifest, origin features and targets, keyed by series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import FoldPlan
from monthwise.functions.months import index_of, month_of_index
from monthwise.operators.series import along, at_offset, count_until, on_month_axis, trailing_count

SERIES = ("source_dataset", "series_id")


def split_of(month: Column, plan: FoldPlan) -> Column:
    """Split name of an origin month index."""
    return (
        F.when(month < index_of(plan.development_start), "training")
        .when(month < index_of(plan.holdout_start), "development")
        .otherwise("holdout")
    )


def issue_time(month: Column) -> Column:
    """An origin's forecast is issued when the next month begins, UTC."""
    return month_of_index(month + 1).cast("timestamp")


def split_manifest(spark: SparkSession, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """forecast_split_manifest: one row per origin month."""
    month = F.col("m")
    origins = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(index_of(plan.origin_start)), F.lit(index_of(plan.origin_end)))
        ).alias("m")
    )
    return contracts.conform(
        origins.select(
            month_of_index(month).alias("origin_month"),
            F.lit(plan.mode).alias("evaluation_mode"),
            F.lit(plan.history_months).alias("minimum_observed_history_months"),
            F.lit(plan.labeled_origins).alias("minimum_labeled_training_origins"),
            issue_time(month).alias("issue_at_utc"),
            split_of(month, plan).alias("split_name"),
        ),
        "forecast_split_manifest",
    )


def series_manifest(prices: DataFrame, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """The manifest repeated for every series, on the month axis of the evaluation."""
    month = F.col("m")
    return month_axis(prices, plan).where(is_origin(plan)).select(
        *SERIES,
        month_of_index(month).alias("origin_month"),
        F.lit(plan.mode).alias("evaluation_mode"),
        F.lit(plan.history_months).alias("minimum_observed_history_months"),
        F.lit(plan.labeled_origins).alias("minimum_labeled_training_origins"),
        issue_time(month).alias("issue_at_utc"),
        split_of(month, plan).alias("split_name"),
    )


def _month(index: int) -> date:
    return date(index // 12, index % 12 + 1, 1)


def month_axis(prices: DataFrame, plan: FoldPlan) -> DataFrame:
    """Price facts of every series on the months that any fold can look at."""
    reach = max(plan.history_months - 1, *plan.lags, plan.season_months)
    first = min(index_of(plan.history_start), index_of(plan.origin_start) - reach)
    last = index_of(plan.origin_end) + max(plan.horizons)
    renamed = prices.select(
        "source_dataset",
        F.col("benchmark_series").alias("series_id"),
        "month_key",
        F.col("price_usd_per_kg").alias("price"),
        F.col("source_capture_id").alias("capture_id"),
    )
    return on_month_axis(
        renamed, SERIES, "month_key", ("price", "capture_id"), _month(first), _month(last)
    )


def with_fold_columns(axis: DataFrame, plan: FoldPlan) -> DataFrame:
    """Every fold column of an origin, in windows over one sorted series.

    * ``observed_history``: prices in the trailing history window,
    * ``lag_<k>``: price and capture exactly k months earlier,
    * ``ahead_<h>``: price and capture exactly h months later,
    * ``season_<h>``: price and capture a season before the target,
    * ``labeled_<h>``: earlier origins whose target month is already past.
    """
    series = along(SERIES)
    month, price = F.col("m"), F.col("price")
    both = F.struct("price", "capture_id")
    columns = {"observed_history": trailing_count(price, plan.history_months, series)}
    for k in plan.lags:
        columns[f"lag_{k}"] = at_offset(both, -k, series)
    for h in plan.horizons:
        columns[f"ahead_{h}"] = at_offset(both, h, series)
        columns[f"season_{h}"] = at_offset(both, h - plan.season_months, series)
    framed = axis.withColumns(columns)
    labeled = {
        f"labeled_{h}": count_until(
            (month >= index_of(plan.origin_start))
            & price.isNotNull()
            & F.col(f"ahead_{h}.price").isNotNull(),
            h,
            series,
        )
        for h in plan.horizons
    }
    return framed.withColumns(labeled)


def is_origin(plan: FoldPlan) -> Column:
    return F.col("m").between(index_of(plan.origin_start), index_of(plan.origin_end))


def origin_features(prices: DataFrame, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """forecast_origin_features: exact calendar lags and the history gate per origin."""
    month = F.col("m")
    lags = [
        column
        for k in plan.lags
        for column in (
            month_of_index(month - k).alias(f"lag_{k}_month"),
            F.col(f"lag_{k}.price").alias(f"lag_{k}_usd_per_kg"),
            F.col(f"lag_{k}.capture_id").alias(f"lag_{k}_capture_id"),
        )
    ]
    return (
        with_fold_columns(month_axis(prices, plan), plan)
        .where(is_origin(plan))
        .select(
            *SERIES,
            month_of_index(month).alias("origin_month"),
            issue_time(month).alias("issue_at_utc"),
            split_of(month, plan).alias("split_name"),
            F.lit(plan.mode).alias("evaluation_mode"),
            *lags,
            F.col("observed_history")
            .cast("int")
            .alias(f"observed_history_months_{plan.history_months}"),
            (F.col("observed_history") == plan.history_months).alias("has_minimum_history"),
        )
    )


def horizon_rows(plan: FoldPlan) -> Column:
    """Generator: one struct per horizon with its target, seasonal input and label count."""
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(h).alias("horizon_months"),
                    F.col(f"ahead_{h}").alias("ahead"),
                    F.col(f"season_{h}").alias("season"),
                    F.col(f"labeled_{h}").cast("int").alias("labeled"),
                )
                for h in plan.horizons
            ]
        )
    )


def targets(prices: DataFrame, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """forecast_targets: label of each origin and horizon with its count of usable origins."""
    month = F.col("m")
    return contracts.conform(
        with_fold_columns(month_axis(prices, plan), plan)
        .where(is_origin(plan))
        .select(*SERIES, "m", horizon_rows(plan).alias("h"))
        .select(
            *SERIES,
            month_of_index(month).alias("origin_month"),
            issue_time(month).alias("issue_at_utc"),
            split_of(month, plan).alias("split_name"),
            F.lit(plan.mode).alias("evaluation_mode"),
            F.col("h.horizon_months"),
            month_of_index(month + F.col("h.horizon_months")).alias("target_month"),
            F.col("h.ahead.price").alias("target_usd_per_kg"),
            F.col("h.ahead.capture_id").alias("target_capture_id"),
            F.col("h.labeled").alias("labeled_training_origins"),
        ),
        "forecast_targets",
    )
