"""Rolling-origin evaluation of many series at once.

The whole evaluation is one chain: the month axis shuffles by series once, and every
later window or grouped pass is keyed by the series and something more, so Spark keeps
the partitioning.  Nothing is joined back, hence nothing is computed twice.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import FoldPlan
from monthwise.functions.months import index_of, month_of_index
from monthwise.operators.series import along, run_id
from monthwise.plans.folds import (
    SERIES,
    horizon_rows,
    is_origin,
    issue_time,
    month_axis,
    split_of,
    with_fold_columns,
)


def with_history_runs(axis: DataFrame, plan: FoldPlan) -> DataFrame:
    """Adds ``observed``, ``island`` and ``run_length``: unbroken history up to each month."""
    observed = (F.col("m") >= index_of(plan.history_start)) & F.col("price").isNotNull()
    marked = axis.withColumn("observed", observed)
    numbered = marked.withColumn("island", run_id(F.col("observed"), along(SERIES)))
    upto = _island().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.withColumn(
        "run_length", F.count_if("observed").over(upto).cast("int")
    )


def _island():
    return Window.partitionBy(*SERIES, "island").orderBy("m")


def with_autoregression(runs: DataFrame, plan: FoldPlan) -> DataFrame:
    """Adds ``slope``, ``intercept`` and ``fit_ok`` of y[t] on y[t-1] over the run so far.

    A fit counts only with a full-rank design: the smaller singular value of the
    matrix (1, x) must exceed machine epsilon times its row count times the larger.
    Both follow from its trace and determinant.
    """
    y = F.when(F.col("observed"), F.col("price").cast("double"))
    paired = runs.withColumn("y", y).withColumn("x", F.lag("y").over(_island()))
    upto = _island().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitted = paired.withColumns(
        {
            "slope": F.regr_slope("y", "x").over(upto),
            "intercept": F.regr_intercept("y", "x").over(upto),
            "pairs": F.regr_count("y", "x").over(upto),
            "spread": F.regr_sxx("y", "x").over(upto),
            "squares": F.sum(F.col("x") * F.col("x")).over(upto),
        }
    )
    trace = F.col("pairs") + F.col("squares")
    determinant = F.col("pairs") * F.col("spread")
    larger = (
        trace + F.sqrt(F.greatest(trace * trace - 4 * determinant, F.lit(0.0)))
    ) / 2
    tolerance = F.lit(sys.float_info.epsilon) * F.greatest(F.col("pairs"), F.lit(2))
    full_rank = determinant > tolerance * tolerance * larger * larger
    ok = (
        (F.col("run_length") >= plan.history_months)
        & full_rank
        & is_finite(F.col("slope"))
        & is_finite(F.col("intercept"))
    )
    return fitted.withColumn("fit_ok", F.coalesce(ok, F.lit(False))).drop(
        "x", "y", "pairs", "spread", "squares"
    )


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def autoregression_fits(prices: DataFrame, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """Expanding fits per series and month, with the length of history behind each."""
    return with_autoregression(
        with_history_runs(month_axis(prices, plan), plan), plan
    ).select(
        *SERIES, month_of_index(F.col("m")).alias("month_key"), "run_length",
        F.when(F.col("fit_ok"), F.col("slope")).alias("slope"),
        F.when(F.col("fit_ok"), F.col("intercept")).alias("intercept"),
        "fit_ok",
    ).where(F.col("run_length") > 0)


def candidate_rows(prices: DataFrame, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """One row per series, evaluated origin, horizon and model: prediction and errors."""
    month = F.col("m")
    last_development = index_of(plan.holdout_start) - 1
    axis = with_fold_columns(month_axis(prices, plan), plan)
    fits = with_autoregression(with_history_runs(axis, plan), plan)
    fit = F.struct("intercept", "slope", "fit_ok")
    frozen = F.max(F.when(month == last_development, fit)).over(Window.partitionBy(*SERIES))
    used = F.when(month > last_development, frozen).otherwise(fit)
    origins = (
        fits.withColumn("fit", used)
        .where(is_origin(plan) & (month >= index_of(plan.development_start)))
        .select(
            *SERIES, "m", "price", "capture_id", "fit",
            (F.col("observed_history") == plan.history_months).alias("has_history"),
            horizon_rows(plan).alias("h"),
        )
    )
    models = F.array(
        *[
            F.struct(F.lit(n).alias("model_order"), F.lit(name).alias("model_name"))
            for n, name in enumerate(plan.models)
        ]
    )
    rows = origins.withColumn("split_name", split_of(month, plan)).select(
        *SERIES, "m", "split_name", "price", "capture_id", "fit", "has_history", "h.*",
        F.explode(models).alias("model"),
    ).select("*", "model.*").drop("model")

    origin_value = F.col("price").cast("double")
    iterated = F.lit(None).cast("double")
    for h in plan.horizons:
        step = origin_value
        for _ in range(h):
            step = F.col("fit.intercept") + F.col("fit.slope") * step
        iterated = F.when(F.col("horizon_months") == h, step).otherwise(iterated)
    name = F.col("model_name")
    eligible = F.col("has_history") & (F.col("labeled") >= plan.labeled_origins)
    fit_used = F.coalesce(F.col("fit.fit_ok"), F.lit(False)) & is_finite(iterated)
    prediction = F.when(
        eligible,
        F.when(name == "persistence", origin_value)
        .when(name == "seasonal_naive", F.col("season.price").cast("double"))
        .when(fit_used, iterated),
    )
    status = (
        F.when(~eligible, "insufficient_history")
        .when((name == "seasonal_naive") & F.col("season.price").isNull(), "missing_seasonal_input")
        .when((name == "ar1") & ~fit_used, "failed_fit")
        .when((name == "persistence") & F.col("price").isNull(), "missing_origin_input")
        .otherwise("ok")
    )
    target_month = month + F.col("horizon_months")
    # A development label past the development end would leak holdout months.
    allowed = (F.col("split_name") != "development") | (target_month <= last_development)
    scored = rows.withColumns(
        {
            "target_m": target_month,
            "prediction": prediction,
            "fit_status": status,
            "actual": F.when(allowed, F.col("ahead.price").cast("double")),
            "target_capture_id": F.when(allowed, F.col("ahead.capture_id")),
        }
    )
    error = F.col("prediction") - F.col("actual")
    scale = (F.abs("prediction") + F.abs("actual")) / 2
    return scored.withColumns(
        {
            "absolute_error": F.abs(error),
            "squared_error": error * error,
            "smape_percent": F.when(scale == 0, F.lit(0.0)).otherwise(
                100 * F.abs(error) / F.when(scale != 0, scale)
            ),
        }
    )


def with_intervals(rows: DataFrame, plan: FoldPlan) -> DataFrame:
    """Symmetric empirical intervals from residuals known at each origin.

    The frame ends one horizon before the origin, so a residual enters once its target
    month is past; masked development labels carry no residual, which also freezes the
    holdout's set at the development end.  A frame holds at most one residual per
    evaluated origin of one series.
    """
    own = Window.partitionBy(*SERIES, "horizon_months", "model_name").orderBy("m")
    residual = F.when(F.col("split_name") == "development", F.col("absolute_error"))
    prior = F.lit(None).cast("array<double>")
    for h in plan.horizons:
        known = F.collect_list(residual).over(own.rangeBetween(Window.unboundedPreceding, -h))
        prior = F.when(F.col("horizon_months") == h, known).otherwise(prior)
    has_prediction = F.col("prediction").isNotNull()
    n = F.col("calibration_count")
    position = F.least(n, F.ceil((n + 1) * plan.interval_level)).cast("int")
    return (
        rows.withColumn("prior", F.array_sort(prior))
        .withColumn(
            "calibration_count",
            F.when(has_prediction, F.size("prior").cast("long")).otherwise(F.lit(0).cast("long")),
        )
        .withColumn(
            "radius",
            F.when(n >= plan.calibration_minimum, F.try_element_at("prior", position)),
        )
        .withColumns(
            {
                "interval_lower": F.col("prediction") - F.col("radius"),
                "interval_upper": F.col("prediction") + F.col("radius"),
            }
        )
        .withColumn(
            "interval_covered",
            F.col("actual").between(F.col("interval_lower"), F.col("interval_upper")),
        )
        .drop("prior", "radius")
    )


def with_selection(rows: DataFrame, plan: FoldPlan) -> DataFrame:
    """Adds each model's development comparison and ``is_selected``.

    Per series and horizon the lowest development error wins among models that scored
    every origin the first model scored; ties follow model order.  A series without a
    complete comparison selects nothing (``selection_gaps`` lists those).
    """
    last_development = index_of(plan.holdout_start) - 1
    group = [*SERIES, "horizon_months"]
    in_development = (F.col("split_name") == "development") & (
        F.col("target_m") <= last_development
    )
    first_scored = F.when(
        F.col("model_name") == plan.models[0], F.col("absolute_error").isNotNull()
    )
    compared = rows.withColumn(
        "compared",
        in_development
        & F.coalesce(F.bool_or(first_scored).over(Window.partitionBy(*group, "m")), F.lit(False)),
    )
    own = Window.partitionBy(*group, "model_name")
    common_error = F.when(F.col("compared"), F.col("absolute_error"))
    judged = compared.withColumns(
        {
            "common_origins": F.count_if("compared").over(own),
            "common_scored": F.count(common_error).over(own),
            "development_mae": F.avg(common_error).over(own),
        }
    )
    complete = (F.col("common_origins") > 0) & (
        F.col("common_scored") == F.col("common_origins")
    )
    best = F.min(
        F.when(complete, F.struct("development_mae", "model_order", "model_name"))
    ).over(Window.partitionBy(*group))
    return (
        judged.withColumn("selected_model", best.getField("model_name"))
        .withColumn(
            "is_selected", F.coalesce(F.col("selected_model") == F.col("model_name"), F.lit(False))
        )
        .withColumn("in_summary", (F.col("split_name") != "development") | in_development)
    )


def evaluated_rows(prices: DataFrame, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """Candidate rows with intervals and selection; predictions and metrics derive from it."""
    return with_selection(with_intervals(candidate_rows(prices, plan), plan), plan)


def predictions_of(rows: DataFrame, run_id: str, plan: FoldPlan = FoldPlan()) -> DataFrame:
    """forecast_predictions of evaluated rows."""
    seasonal = F.col("model_name") == "seasonal_naive"
    return contracts.conform(
        rows.select(
            F.lit(run_id).alias("run_id"),
            *SERIES,
            month_of_index(F.col("m")).alias("origin_month"),
            month_of_index(F.col("target_m")).alias("target_month"),
            issue_time(F.col("m")).alias("issue_at_utc"),
            "split_name",
            F.lit(plan.mode).alias("evaluation_mode"),
            "horizon_months",
            "model_name",
            "fit_status",
            F.col("labeled").alias("labeled_training_origins"),
            F.col("capture_id").alias("origin_capture_id"),
            F.when(
                seasonal, month_of_index(F.col("target_m") - plan.season_months)
            ).alias("seasonal_input_month"),
            F.when(seasonal, F.col("season.capture_id")).alias("seasonal_input_capture_id"),
            "target_capture_id",
            F.col("prediction").alias("prediction_usd_per_kg"),
            F.col("actual").alias("target_usd_per_kg"),
            "absolute_error", "squared_error", "smape_percent",
            "interval_lower", "interval_upper", "interval_covered", "calibration_count",
        ),
        "forecast_predictions",
    )


def metrics_of(rows: DataFrame, run_id: str) -> DataFrame:
    """forecast_metrics of evaluated rows: one row per series, split, horizon and model."""
    scored = F.col("absolute_error").isNotNull()
    interval = scored & F.col("interval_lower").isNotNull()
    return contracts.conform(
        rows.where("in_summary")
        .groupBy(*SERIES, "split_name", "horizon_months", "model_name")
        .agg(
            F.bool_or("is_selected").alias("is_selected"),
            F.count(F.lit(1)).alias("origin_count"),
            F.count("prediction").alias("prediction_count"),
            F.count_if(scored).alias("scored_count"),
            F.count_if(F.col("actual").isNull()).alias("missing_target_count"),
            F.count_if(F.col("fit_status") == "failed_fit").alias("failed_fit_count"),
            F.avg("absolute_error").alias("mae"),
            F.sqrt(F.avg("squared_error")).alias("rmse"),
            F.avg("smape_percent").alias("smape_percent"),
            F.count_if(interval).alias("interval_scored_count"),
            F.avg(F.when(interval, F.col("interval_covered").cast("double"))).alias(
                "interval_coverage"
            ),
            F.avg(F.when(interval, F.col("interval_upper") - F.col("interval_lower"))).alias(
                "mean_interval_width"
            ),
        )
        .withColumn("run_id", F.lit(run_id)),
        "forecast_metrics",
    )


def selections_of(rows: DataFrame) -> DataFrame:
    """Selected model per series and horizon with the comparison behind it."""
    return (
        rows.where(F.col("is_selected"))
        .groupBy(*SERIES, "horizon_months")
        .agg(
            F.min("model_name").alias("selected_model"),
            F.min("development_mae").alias("development_mae"),
            F.min("common_origins").alias("common_origins"),
        )
    )


def selection_gaps(rows: DataFrame) -> DataFrame:
    """Series and horizons for which no model has a complete development comparison."""
    return (
        rows.groupBy(*SERIES, "horizon_months")
        .agg(F.max("selected_model").alias("selected_model"))
        .where(F.col("selected_model").isNull())
        .select(*SERIES, "horizon_months")
    )
