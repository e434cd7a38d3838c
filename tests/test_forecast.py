import math
from datetime import date
from decimal import Decimal

import numpy as np
import pytest

from monthwise import contracts
from monthwise.domain import FoldPlan
from monthwise.functions.months import index_of
from monthwise.operators.scope import row_differences
from monthwise.plans import checks, facts, folds, forecast
from tests.conftest import as_dicts


def month(index):
    return date(index // 12, index % 12 + 1, 1)


def price_facts(spark, series, captures=None):
    rows = [
        ("pink", name, day, str(value), None if value is None else Decimal(str(value)),
         (captures or {}).get(day, "capture-a"), None)
        for name, values in series.items()
        for day, value in values.items()
    ]
    frame = spark.createDataFrame(rows, contracts.schema("monthly_prices"))
    return facts.benchmark_prices(facts.price_changes(frame))


def span(first, last):
    return [month(n) for n in range(index_of(first), index_of(last) + 1)]


def seasonal_series():
    return {
        day: round(10 + 0.03 * n + 0.2 * (n % 4), 8)
        for n, day in enumerate(span(date(2015, 1, 1), date(2026, 3, 1)))
    }


def wandering_series(seed, gaps=()):
    draw = np.random.default_rng(seed)
    values, level = {}, 50.0
    for day in span(date(2015, 1, 1), date(2026, 3, 1)):
        level = 5 + 0.9 * level + draw.normal()
        if day not in gaps:
            values[day] = round(level, 8)
    return values


@pytest.fixture(scope="module")
def evaluated(spark):
    series = {
        "steady": seasonal_series(),
        "wander": wandering_series(1),
        "gapped": wandering_series(2, (date(2023, 5, 1),)),
        "flat": {day: 7.0 for day in span(date(2015, 1, 1), date(2026, 3, 1))},
    }
    frame = forecast.evaluated_rows(price_facts(spark, series)).cache()
    return series, frame


def test_calendar_offsets_and_label_counts(spark):
    prices = {day: n + 1 for n, day in enumerate(span(date(2015, 1, 1), date(2026, 4, 1)))}
    del prices[date(2023, 12, 1)]
    prices[date(2024, 2, 1)], prices[date(2024, 4, 1)] = 999, 777
    frame = price_facts(spark, {"cocoa": prices}, {date(2024, 2, 1): "capture-b", date(2024, 4, 1): "capture-c"})
    row = as_dicts(folds.origin_features(frame).where("origin_month = '2024-01-01'"))[0]
    assert [row[f"lag_{k}_usd_per_kg"] for k in (0, 1, 3, 12)] == [109, None, 106, 97]
    assert row["observed_history_months_60"] == 59 and row["has_minimum_history"] is False
    assert row["lag_1_month"] == date(2023, 12, 1) and row["lag_1_capture_id"] is None
    targets = folds.targets(frame)
    future = {r["horizon_months"]: r for r in as_dicts(targets.where("origin_month = '2024-01-01'"))}
    assert (future[1]["target_usd_per_kg"], future[1]["target_capture_id"]) == (999, "capture-b")
    assert (future[3]["target_usd_per_kg"], future[3]["target_capture_id"]) == (777, "capture-c")
    labels = {r["horizon_months"]: r["labeled_training_origins"] for r in as_dicts(targets.where("origin_month = '2020-01-01'"))}
    assert labels == {1: 48, 3: 46}
    manifest = folds.split_manifest(spark)
    splits = {r["split_name"]: r["count"] for r in manifest.groupBy("split_name").count().collect()}
    assert splits == {"training": 48, "development": 48, "holdout": 24}
    tallies = checks.fold_invariants(manifest, folds.origin_features(frame), targets)
    assert {r["violations"] for r in as_dicts(tallies)} == {0}


def test_repeated_months_fail(spark):
    frame = price_facts(spark, {"s": {date(2020, 1, 1): 1}})
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|[Dd]uplicate"):
        folds.targets(frame.unionByName(frame)).collect()


def test_as_of_mode_is_refused():
    with pytest.raises(ValueError):
        FoldPlan(mode="as_of")
    with pytest.raises(ValueError):
        FoldPlan(holdout_start=date(2019, 1, 1))


def least_squares(history):
    y = np.array(history)
    design = np.column_stack([np.ones(len(y) - 1), y[:-1]])
    (intercept, slope), _, rank, _ = np.linalg.lstsq(design, y[1:], rcond=None)
    return (intercept, slope) if rank == 2 else None


def brute_force(prices, plan=FoldPlan()):
    """Predictions and radii of one series by direct search, for comparison only."""
    at = {index_of(day): float(v) for day, v in prices.items()}
    start, dev, hold = (index_of(d) for d in (plan.history_start, plan.development_start, plan.holdout_start))
    first = index_of(plan.origin_start)

    def run(end):
        length = 0
        while end - length >= start and end - length in at:
            length += 1
        return [at[n] for n in range(end - length + 1, end + 1)]

    rows = {}
    for t in range(dev, index_of(plan.origin_end) + 1):
        for h in plan.horizons:
            enough = all(n in at for n in range(t - 59, t + 1))
            labels = sum(p in at and p + h in at for p in range(first, t - h + 1))
            history = run(t if t < hold else hold - 1)
            fit = least_squares(history) if len(history) >= 60 else None
            path = at.get(t)
            if fit and path is not None:
                for _ in range(h):
                    path = fit[0] + fit[1] * path
            guesses = {"persistence": at.get(t), "seasonal_naive": at.get(t + h - 12), "ar1": path if fit else None}
            for model, guess in guesses.items():
                guess = guess if enough and labels >= 48 else None
                actual = at.get(t + h) if t >= hold or t + h < hold else None
                error = None if guess is None or actual is None else abs(guess - actual)
                rows[(t, h, model)] = (guess, actual, error)
    result = {}
    for (t, h, model), (guess, actual, error) in rows.items():
        limit = min(t, hold - 1)
        prior = sorted(
            rows[(p, h, model)][2]
            for p in range(dev, t)
            if p < hold and p + h <= limit and rows[(p, h, model)][2] is not None
        )
        rank = min(len(prior), math.ceil((len(prior) + 1) * 0.9))
        radius = prior[rank - 1] if guess is not None and len(prior) >= 12 else None
        result[(month(t), h, model)] = (guess, actual, radius, len(prior) if guess is not None else 0)
    return result


@pytest.mark.parametrize("name", ["steady", "wander", "gapped"])
def test_predictions_match_direct_search(evaluated, name):
    series, frame = evaluated
    expected = brute_force(series[name])
    rows = as_dicts(forecast.predictions_of(frame, "r").where(f"series_id = '{name}'"))
    assert len(rows) == len(expected) == 72 * 2 * 3
    for row in rows:
        guess, actual, radius, prior = expected[(row["origin_month"], row["horizon_months"], row["model_name"])]
        assert row["prediction_usd_per_kg"] == pytest.approx(guess, rel=1e-9) if guess is not None else row["prediction_usd_per_kg"] is None
        assert row["target_usd_per_kg"] == actual
        assert row["calibration_count"] == prior
        if radius is None:
            assert row["interval_lower"] is None
        else:
            assert row["interval_upper"] - guess == pytest.approx(radius, rel=1e-6, abs=1e-9)


def test_gates_masks_and_counts(evaluated):
    _, frame = evaluated
    predictions = forecast.predictions_of(frame, "r").where("series_id = 'steady'")
    early = as_dicts(predictions.where("origin_month = '2020-01-01' and horizon_months = 3"))
    assert {r["fit_status"] for r in early} == {"insufficient_history"}
    seasonal = as_dicts(predictions.where("origin_month = '2020-01-01' and horizon_months = 1 and model_name = 'seasonal_naive'"))[0]
    assert seasonal["seasonal_input_month"] == date(2019, 2, 1)
    masked = predictions.where("split_name = 'development' and target_month > '2023-12-01'")
    assert masked.where("target_usd_per_kg is not null or target_capture_id is not null").count() == 0
    assert predictions.where("split_name = 'holdout'").count() == 144
    metrics = forecast.metrics_of(frame.where("series_id = 'steady'"), "r")
    assert metrics.count() == 12
    assert metrics.where("split_name = 'development' and is_selected").count() == 2


def test_history_lengths(spark):
    fits = forecast.autoregression_fits(price_facts(spark, {"s": seasonal_series()}))
    lengths = {r["month_key"]: r for r in as_dicts(fits)}
    assert lengths[date(2020, 1, 1)]["run_length"] == 61
    assert lengths[date(2023, 12, 1)]["run_length"] == 108
    assert lengths[date(2019, 11, 1)]["fit_ok"] is False and lengths[date(2019, 12, 1)]["fit_ok"] is True


def test_constant_series_fails_to_fit(evaluated):
    _, frame = evaluated
    rows = as_dicts(frame.where("series_id = 'flat'"))
    fitted = {r["fit_status"] for r in rows if r["model_name"] == "ar1"}
    assert "ok" not in fitted and "failed_fit" in fitted
    assert any(r["prediction"] == 7.0 for r in rows if r["model_name"] == "persistence")
    chosen = {r["selected_model"] for r in as_dicts(forecast.selections_of(frame.where("series_id = 'flat'")))}
    assert chosen == {"persistence"}


def test_result_invariants(evaluated):
    _, frame = evaluated
    predictions, metrics = forecast.predictions_of(frame, "r"), forecast.metrics_of(frame, "r")
    counts = {r["check_name"]: r["violations"] for r in as_dicts(checks.result_invariants(predictions, metrics))}
    missing = forecast.selection_gaps(frame).count()
    assert counts.pop("selection_count") == missing
    assert set(counts.values()) == {0}
    wrong = metrics.withColumn("scored_count", metrics.scored_count + 1)
    counts = {r["check_name"]: r["violations"] for r in as_dicts(checks.result_invariants(predictions, wrong))}
    assert counts["summary_counts"] == metrics.count()


def test_holdout_labels_leak_nowhere(spark):
    prices = wandering_series(5)
    changed = {day: (999 if day >= date(2024, 1, 1) else v) for day, v in prices.items()}
    plan = FoldPlan()
    kept = ["series_id", "origin_month", "horizon_months", "model_name"]

    def development(values):
        rows = forecast.evaluated_rows(price_facts(spark, {"s": values}), plan)
        predictions = forecast.predictions_of(rows, "r").where("split_name = 'development'")
        return (
            predictions.select(*kept, "prediction_usd_per_kg", "interval_lower", "interval_upper"),
            forecast.selections_of(rows),
        )

    rows, choice = development(prices)
    other_rows, other_choice = development(changed)
    assert row_differences(rows, other_rows).count() == 0
    assert row_differences(choice, other_choice).count() == 0


def test_one_shuffle_after_the_price_table(spark):
    frame = price_facts(spark, {"s": seasonal_series()})
    plan = forecast.metrics_of(forecast.evaluated_rows(frame), "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
