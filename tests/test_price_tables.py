from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.domain import PriceDomain
from monthwise.plans import coverage, facts, marts, presentation
from monthwise.sources import wide_prices
from tests.conftest import as_dicts

CELLS = {"a": "cocoa", "b": "coffee_arabica", "c": "coffee_robusta"}
BOUNDS = (date(2024, 1, 1), date(2024, 4, 1))
SHEET = "source_dataset string, source_capture_id string, row_no int, period_text string, a string, b string, c string"
ROWS = [
    ("pink", "f", 1, "2024M01", "4.4000000000000004", "5", "2"),
    ("pink", "f", 2, "2024M02", "4.84", "5.5", ".."),
    ("pink", "f", 3, None, None, None, None),
    ("pink", "f", 4, "2024M04", "5", "6", "2.123456785"),
    ("pink", "f", 5, "2024M05", "not checked", "6", "1"),
]


def sheets(spark, rows=ROWS):
    return spark.createDataFrame(rows, SHEET)


@pytest.fixture(scope="module")
def prices(spark):
    return wide_prices.parse_sheets(sheets(spark), CELLS, *BOUNDS).cache()


def test_typed_rows(prices):
    rows = {(r["series_id"], r["period_month"].month): r for r in as_dicts(prices)}
    assert len(rows) == 9
    assert rows[("cocoa", 1)]["price_usd_per_kg"] == Decimal("4.40000000")
    assert rows[("cocoa", 1)]["source_value_text"] == "4.4000000000000004"
    assert rows[("coffee_robusta", 2)]["price_usd_per_kg"] is None
    assert rows[("coffee_robusta", 2)]["source_value_text"] == ".."
    # a tie goes to the even digit
    assert rows[("coffee_robusta", 4)]["price_usd_per_kg"] == Decimal("2.12345678")


def test_coverage(prices):
    rows = {r["series_id"]: r for r in as_dicts(wide_prices.price_coverage(prices, *BOUNDS))}
    robusta = rows["coffee_robusta"]
    assert (robusta["requested_month_count"], robusta["represented_month_count"]) == (4, 3)
    assert (robusta["missing_month_count"], robusta["null_price_count"]) == (1, 1)
    assert robusta["latest_observed"] == date(2024, 4, 1)


def test_valid_sheet_has_no_violations(spark):
    assert wide_prices.sheet_violations(sheets(spark), CELLS, *BOUNDS).count() == 0


@pytest.mark.parametrize(
    "row, rule",
    [
        (("pink", "f", 9, "2024M13", "1", "1", "1"), "bad_period"),
        (("pink", "f", 9, "2024-03", "1", "1", "1"), "bad_period"),
        (("pink", "f", 9, None, "1", None, None), "bad_period"),
        (("pink", "f", 9, "2024M01", "1", "1", "1"), "duplicate_period"),
        (("pink", "f", 9, "2024M03", "NaN", "1", "1"), "bad_number"),
        (("pink", "f", 9, "2024M03", "abc", "1", "1"), "bad_number"),
        (("pink", "f", 9, "2024M03", "=B1*2", "1", "1"), "bad_number"),
        (("pink", "f", 9, "2024M03", "1000000000000", "1", "1"), "bad_number"),
        (("pink", "f", 9, "2024M03", "Infinity", "1", "1"), "bad_number"),
    ],
)
def test_broken_rows_are_reported(spark, row, rule):
    found = as_dicts(wide_prices.sheet_violations(sheets(spark, [*ROWS, row]), CELLS, *BOUNDS))
    assert [r["rule"] for r in found] == [rule]


def test_bounds_are_checked():
    assert wide_prices.check_bounds(date(2011, 1, 1), date(2025, 12, 1)) == 180
    for start, end in (
        (date(2024, 2, 1), date(2024, 1, 1)), (date(2011, 1, 1), date(2026, 1, 1)),
        (date(2024, 1, 2), date(2024, 2, 1)),
    ):
        with pytest.raises(ValueError):
            wide_prices.check_bounds(start, end)


def test_headers(spark):
    labels = [name for name, _ in PriceDomain().series_labels]
    texts = [f"{prefix}, details" for prefix, _ in PriceDomain().description_prefixes]
    fine = ("pink", "f", labels, ["($/kg)"] * 3, texts, "Updated on August 4, 2026")
    schema = (
        "source_dataset string, source_capture_id string, labels array<string>, units array<string>, "
        "descriptions array<string>, update_text string"
    )
    cases = {
        "fine": (fine, []),
        "label": ((*fine[:2], ["Tea", *labels[1:]], *fine[3:]), ["labels_changed"]),
        "unit": ((*fine[:3], ["($/mt)", "($/kg)", "($/kg)"], *fine[4:]), ["units_changed"]),
        "text": ((*fine[:4], texts[:2], fine[5]), ["description_mismatch"]),
        "update": ((*fine[:5], " "), ["missing_update_label"]),
    }
    rows = [(record[0], name, *record[2:]) for name, (record, _) in cases.items()]
    frame = spark.createDataFrame(rows, schema)
    found = {}
    for r in as_dicts(wide_prices.header_violations(frame)):
        found.setdefault(r["source_capture_id"], []).append(r["rule"])
    assert found == {name: rules for name, (_, rules) in cases.items() if rules}
    dates = {r["source_capture_id"]: r["source_update_date"] for r in as_dicts(wide_prices.update_dates(frame))}
    assert dates["fine"] == date(2026, 8, 4) and dates["update"] is None


def test_changes_need_adjacent_months(prices):
    changes = facts.price_changes(prices)
    rows = {(r["series_id"], r["period_month"].month): r for r in as_dicts(changes)}
    assert rows[("cocoa", 2)]["change_usd_per_kg"] == Decimal("0.44000000")
    assert rows[("cocoa", 2)]["change_percent"] == pytest.approx(10)
    assert rows[("cocoa", 1)]["change_usd_per_kg"] is None
    assert rows[("cocoa", 4)]["change_usd_per_kg"] is None
    assert rows[("coffee_robusta", 2)]["change_usd_per_kg"] is None
    assert changes.schema["change_usd_per_kg"].dataType.simpleString() == "decimal(21,8)"


def test_zero_price_has_change_but_no_percent(spark):
    rows = [
        ("d", "s", date(2024, 1, 1), "0", Decimal(0), "c", None),
        ("d", "s", date(2024, 2, 1), "1", Decimal(1), "c", None),
    ]
    frame = spark.createDataFrame(rows, contracts.schema("monthly_prices"))
    last = as_dicts(facts.price_changes(frame), "period_month")[1]
    assert last["change_usd_per_kg"] == 1 and last["change_percent"] is None
    index = as_dicts(marts.benchmark_dynamics(facts.benchmark_prices(facts.price_changes(frame))))
    assert {r["benchmark_index"] for r in index} == {None}


def test_index_and_ranges(prices):
    dynamics = marts.benchmark_dynamics(facts.benchmark_prices(facts.price_changes(prices)))
    rows = {(r["benchmark_series"], r["month_key"].month): r for r in as_dicts(dynamics)}
    assert rows[("cocoa", 1)]["benchmark_index"] == 100.0
    assert rows[("cocoa", 2)]["benchmark_index"] == pytest.approx(110)
    assert rows[("cocoa", 1)]["commodity_key"] == "cocoa"
    assert rows[("coffee_arabica", 1)]["commodity_key"] == "coffee"
    ranges = presentation.observed_ranges(dynamics)
    robusta = as_dicts(ranges.where("benchmark_series = 'coffee_robusta'"))[0]
    assert robusta["observed_months"] == 2
    assert presentation.partial_series(ranges).count() == 0
    cut = dynamics.withColumn(
        "price_usd_per_kg", F.when(F.col("month_key") < date(2024, 4, 1), F.col("price_usd_per_kg"))
    )
    assert presentation.partial_series(presentation.observed_ranges(cut)).count() == 3


def test_freshness(prices):
    rows = {r["series_id"]: r for r in as_dicts(coverage.price_freshness(prices, date(2024, 6, 20)))}
    assert rows["cocoa"]["observed_age_months"] == 2
