from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.functions.numbers import half_even_decimal
from monthwise.functions.signatures import fingerprint
from monthwise.operators import registry
from monthwise.operators.scope import (
    Scope, clip_ranges, in_scope, replace_rows, requested_pairs, row_differences, selection_gaps,
    slice_scopes, uncovered_months, vintage,
)
from monthwise.plans import checks, coverage, facts, marts, publish
from monthwise.session import checkpoint_folder
from tests.conftest import FIXTURE, as_dicts, cell_frame, fact_frame

DEC = date(2021, 12, 1)
SCOPE = Scope(DEC, DEC, {"flow_code": ("1",), "reporter_code": ("DE",)})
REVISED = (
    ("2021-12-01", "BR", "09011100", "1", "1200", "5.5", None),
    ("2021-12-01", "QS", "09011100", "1", "100", "1", None),
    ("2021-12-01", "QS", "09011100", "2", "999", "9", None),
    ("2021-12-01", "WORLD", "09011100", "1", "1500", "7", None),
)


def test_replacement_withdraws_adds_and_keeps(spark):
    first = cell_frame(spark)
    second = cell_frame(spark, REVISED, "capture-b")
    result = replace_rows(first, second, [SCOPE])
    fact = fact_frame(spark, result)
    rows = {(r["partner_code"], r["product_code"], r["flow_code"]): r for r in as_dicts(fact.where("month_key = '2021-12-01'"))}
    assert set(rows) == {
        ("BR", "09011100", "1"), ("QS", "09011100", "1"), ("QS", "09011100", "2"),
        ("WORLD", "09011100", "1"), ("WORLD", "09011100", "2"),
    }
    assert rows[("BR", "09011100", "1")]["trade_value_eur"] == 1200
    assert rows[("QS", "09011100", "2")]["trade_value_eur"] == 200
    balance = as_dicts(marts.trade_balances(fact).where("month_key = '2021-12-01'"))[0]
    assert balance["trade_balance_eur"] == -1250
    block = as_dicts(marts.partner_concentration(fact).where("month_key = '2021-12-01' and flow_code = '1'"))[0]
    assert (block["named_partner_value_eur"], block["observed_special_value_eur"]) == (1200, 100)
    assert block["reconciliation_residual_eur"] == 200
    same = publish.untouched_differences(first, result, [SCOPE]).select("row_count", "content_hash")
    assert same.distinct().count() == 1
    again = replace_rows(result, second, [SCOPE])
    assert row_differences(again, result).count() == 0
    restored = replace_rows(result, first, [SCOPE])
    assert row_differences(restored, first).count() == 0
    assert vintage(result, ["capture-b"]).count() == 6


def test_empty_version_withdraws_the_scope(spark):
    first = cell_frame(spark)
    result = replace_rows(first, cell_frame(spark, ()), [SCOPE])
    assert result.count() == 12
    fact = fact_frame(spark, result)
    assert fact.count() == 6
    row = as_dicts(marts.trade_balances(fact).where("month_key = '2021-12-01'"))[0]
    assert (row["import_value_cif_eur"], row["export_value_fob_eur"], row["trade_balance_eur"]) == (None, 250, None)


def test_scope_predicate_edges(spark):
    cells = cell_frame(spark)
    assert cells.where(in_scope(None)).count() == 18
    assert cells.where(in_scope([])).count() == 0
    unknown = cells.withColumn("flow_code", F.lit(None).cast("string"))
    assert replace_rows(unknown, unknown.limit(0), [SCOPE]).count() == 18
    with pytest.raises(ValueError):
        Scope(date(2022, 1, 1), DEC, {})
    with pytest.raises(ValueError):
        replace_rows(cells, cells.drop("source_status"), [SCOPE])


def test_table_replacement_in_place(spark, tmp_path):
    path = str(tmp_path / "cells")
    first = cell_frame(spark)
    publish.write_month_table(first, path)
    columns = first.columns

    def stored():
        return spark.read.schema(first.schema).parquet(path).select(columns)

    assert row_differences(stored(), first).count() == 0
    publish.replace_in_table(spark, path, cell_frame(spark, REVISED, "capture-b"), [SCOPE], "monthly_trade")
    expected = replace_rows(first, cell_frame(spark, REVISED, "capture-b"), [SCOPE])
    assert row_differences(stored(), expected).count() == 0
    whole = Scope(DEC, DEC, {"reporter_code": ("DE",)})
    emptied = publish.replace_in_table(spark, path, cell_frame(spark, ()), [whole], "monthly_trade")
    assert emptied == [DEC]
    assert stored().where(F.col("period_month") == DEC).count() == 0
    assert stored().count() == first.where("period_month = '2022-01-01'").count()
    plan = stored().where(in_scope([SCOPE]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_fingerprint_sees_repeats_and_ignores_order(spark):
    rows = cell_frame(spark)
    one = fingerprint(rows, "t").first()
    assert fingerprint(rows.orderBy(F.desc("partner_code")), "t").first() == one
    assert fingerprint(rows.unionByName(rows), "t").first() != one
    assert fingerprint(rows.limit(0), "t").first()["row_count"] == 0


def test_selection_resolution(spark):
    schema = (
        "slice_id string, reporter_code string, start_month date, end_month date, products array<string>, "
        "partners array<string>"
    )
    slices = spark.createDataFrame(
        [
            ("a", "DE", date(2021, 1, 1), date(2021, 12, 1), ["09011100", "18069090"], ["WORLD", "BR"]),
            ("b", "DE", date(2022, 1, 1), date(2022, 12, 1), ["09011100"], ["WORLD"]),
            ("c", "DE", date(2023, 1, 1), date(2023, 12, 1), ["09011100"], ["WORLD"]),
        ],
        schema,
    )
    bounds, products = (date(2021, 11, 1), date(2022, 1, 1)), ("09011100", "18069090")
    scoped = slice_scopes(slices, *bounds, products, ("1",))
    rows = {r["slice_id"]: r for r in as_dicts(scoped)}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["start_month"] == date(2021, 11, 1) and rows["a"]["products"] == list(products)
    assert rows["a"]["partners"] == ["BR", "WORLD"]
    gaps = as_dicts(selection_gaps(scoped, requested_pairs(spark, *bounds, products, ("DE",), ("1",))))
    assert [(g["period_month"], g["product_code"], g["problem"]) for g in gaps] == [
        (date(2022, 1, 1), "18069090", "missing")
    ]
    overlapping = slices.unionByName(slices.where("slice_id = 'b'").withColumn("slice_id", F.lit("d")))
    problems = {
        g["problem"]
        for g in as_dicts(
            selection_gaps(
                slice_scopes(overlapping, *bounds, ("09011100",), ("1",)),
                requested_pairs(spark, *bounds, ("09011100",), ("DE",), ("1",)),
            )
        )
    }
    assert problems == {"overlapping"}
    other = slices.withColumn("reporter_code", F.lit("FR")).withColumn("slice_id", F.concat(F.lit("f"), "slice_id"))
    both = slice_scopes(slices.unionByName(other), *bounds, ("09011100",), ("1",))
    assert selection_gaps(both, requested_pairs(spark, *bounds, ("09011100",), ("DE", "FR"), ("1",))).count() == 0


def test_failed_replacement_leaves_the_table(spark, tmp_path, monkeypatch):
    path, first = str(tmp_path / "kept"), cell_frame(spark, FIXTURE, "capture-a")
    publish.write_month_table(first, path)
    stored = lambda: spark.read.schema(first.schema).parquet(path).select(first.columns)
    key = ("reporter_code", "partner_code", "product_code", "flow_code", "indicator_code", "period_month")
    revised = cell_frame(spark, REVISED, "capture-b")
    replace = lambda frame: publish.replace_in_table(spark, path, frame, [SCOPE], "monthly_trade", key=key)
    with pytest.raises(publish.PublicationError):
        replace(revised.unionByName(revised))
    assert row_differences(stored(), first).count() == 0
    whole = publish.write_verified

    def nothing_staged(frame, target, partition_by=()):
        measures = whole(frame.limit(0), target, partition_by)
        return measures | {"row_count": 5}

    def unreadable(frame, target, partition_by=()):
        return {"row_count": 5}

    for broken in (nothing_staged, unreadable):
        monkeypatch.setattr(publish, "write_verified", broken)
        with pytest.raises(Exception):  # noqa: B017, PT011
            replace(revised)
        assert row_differences(stored(), first).count() == 0
    monkeypatch.setattr(publish, "write_verified", whole)
    replace(revised)
    assert row_differences(stored(), replace_rows(first, revised, [SCOPE])).count() == 0


def test_long_fractions_round_once(spark):
    texts = ["0.000000005000000000000000001", "0.000000005", "0.0000000050000000000000000000", "1.25", "-0.0000000150000000000000000009"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(half_even_decimal(F.col("t"), 20, 8, "1000000000000")).collect()]
    assert got == [Decimal(x) for x in ("1E-8", "0", "0", "1.25", "-2E-8")]


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_folder(Session())


def test_backfill_ranges(spark):
    ranges = spark.createDataFrame(
        [("trade", DEC, date(2022, 2, 1))], "source string, start_month date, end_month date"
    )
    run = (DEC, date(2022, 1, 1))
    assert as_dicts(clip_ranges(ranges, *run)) == [
        {"source": "trade", "start_month": DEC, "end_month": date(2022, 1, 1)}
    ]
    assert uncovered_months(*run, ranges).count() == 0
    assert [r[0] for r in uncovered_months(date(2021, 11, 1), run[1], ranges).collect()] == [date(2021, 11, 1)]


def test_capture_registry_and_history(spark):
    schema = "source_capture_id string, retrieved_at_utc timestamp, source_update_text string"
    day = [datetime(2026, 9, n) for n in range(1, 30)]
    first = registry.merge_captures(
        None, spark.createDataFrame([("p", day[21], "Updated on September 2, 2026")], schema)
    )
    second = registry.merge_captures(
        first, spark.createDataFrame([("p", day[22], "Updated on September 2, 2026"), ("q", day[5], "soon")], schema)
    )
    rows = {r["source_capture_id"]: r for r in as_dicts(second)}
    assert (rows["p"]["retrieved_at_utc"], rows["p"]["first_seen_capture_at_utc"]) == (day[22], day[21])
    assert rows["p"]["source_update_date"] == date(2026, 9, 2) and rows["q"]["source_update_date"] is None

    events = spark.createDataFrame(
        [("prices", "p", day[21], day[22])],
        "dataset string, source_capture_id string, retrieved_at_utc timestamp, selected_at_utc timestamp",
    )
    history = registry.append_history(None, events, "run-a")
    history = registry.append_history(history, events.withColumn("selected_at_utc", F.lit(day[25])), "run-b")
    assert sorted(r["sequence"] for r in as_dicts(history)) == [0, 1]
    assert as_dicts(registry.latest_run(history))[0] == {"run_id": "run-b", "sequence": 1}
    assert as_dicts(registry.first_selected(history))[0]["first_selected_at_utc"] == day[22]

    lineage = checks.capture_lineage(
        [(spark.createDataFrame([("p", "x"), ("p", None)], "a string, b string"), ["a", "b"])], second
    )
    assert [r[0] for r in lineage.collect()] == ["x"]
    used = coverage.provenance({"prices": spark.createDataFrame([("p",), ("x",)], "source_capture_id string")}, second)
    assert {r["source_capture_id"]: r["resolved"] for r in as_dicts(used)} == {"p": True, "x": False}


def test_generations(spark, tmp_path):
    root = str(tmp_path)
    first = cell_frame(spark)
    assert publish.latest_generation(spark, root) == 0
    assert publish.publish_generation(root, {"cells": first}, "build", "r1") == 1
    assert publish.publish_generation(root, {"cells": cell_frame(spark, FIXTURE[:1])}, "build", "r2") == 2
    assert publish.read_generation(spark, root)["cells"].count() == 2
    pinned = publish.read_generation(spark, root, 1)["cells"]
    assert row_differences(pinned.select(first.columns), first).count() == 0
    with pytest.raises(publish.PublicationError):
        publish.read_generation(spark, root, 7)
    with pytest.raises(ValueError):
        publish.publish_generation(root, {"cells": first}, "", "r3")


def test_forecast_runs_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, size in (("a", 3), ("b", 4), ("a", 2)):
        publish.write_forecast_run(spark.range(size).withColumn("run_id", F.lit(run)), path)
    counts = {r["run_id"]: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {"a": 2, "b": 4}


def test_price_revision_changes_the_next_month(spark):
    def rows(first):
        return spark.createDataFrame(
            [
                ("d", "cocoa", date(2024, 1, 1), str(first), Decimal(first), "a", None),
                ("d", "cocoa", date(2024, 2, 1), "4.84", Decimal("4.84"), "a", None),
            ],
            contracts.schema("monthly_prices"),
        )

    scope = Scope(date(2024, 1, 1), date(2024, 1, 1), {"series_id": ("cocoa",)})
    changed = facts.price_changes(replace_rows(rows("4.4"), rows("4.0"), [scope]))
    assert as_dicts(changed, "period_month")[1]["change_usd_per_kg"] == Decimal("0.84000000")
    absent = Scope(date(2024, 3, 1), date(2024, 3, 1), {"series_id": ("cocoa",)})
    assert row_differences(replace_rows(rows("4.4"), rows("4.0"), [absent]), rows("4.4")).count() == 0
