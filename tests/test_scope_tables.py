import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.operators import selection
from monthwise.operators.scope import Scope, replace_rows, row_differences
from monthwise.operators.scope_tables import (
    inside_scopes, outside_scopes, replace_rows_by_table, scope_table, unordered_scopes,
)
from monthwise.operators.vintages import new_captures, version
from monthwise.plans import dims, publish, refresh
from monthwise.sources import footers, tables
from tests.conftest import FIXTURE, as_dicts, cell_frame

DEC, JAN = date(2021, 12, 1), date(2022, 1, 1)
KEYS = ("reporter_code", "product_code", "flow_code", "partner_code")
SCOPES = (
    Scope(DEC, DEC, {"flow_code": ("1",), "reporter_code": ("DE",)}),
    Scope(date(2021, 12, 5), date(2022, 1, 31), {"product_code": ("18069090",)}),
)
REVISED = (
    ("2021-12-01", "BR", "09011100", "1", "1200", "5.5", None),
    ("2021-12-01", "QS", "09011100", "2", "999", "9", None),
    ("2022-01-01", "WORLD", "18069090", "1", "510", "3", None),
)


def test_table_form_equals_literal_form(spark):
    first, second = cell_frame(spark), cell_frame(spark, REVISED, "capture-b")
    for scopes in (SCOPES, SCOPES[:1], SCOPES[1:], ()):
        held = scope_table(spark, scopes, KEYS)
        for salts in (1, 3):
            result = replace_rows_by_table(first, second, held, KEYS, salts=salts)
            assert row_differences(result, replace_rows(first, second, scopes)).count() == 0


def test_thousands_of_scopes_have_a_plan_of_fixed_size(spark):
    pick = random.Random(7)
    rows = [(date(2000 + n // 60, 1 + n % 12, 1), f"p{n % 7}", f"r{n % 3}", None if n % 11 == 0 else f"f{n % 2}", n) for n in range(600)]
    frame = spark.createDataFrame(rows, "period_month date, product_code string, reporter_code string, flow_code string, n long")
    keys = ("product_code", "reporter_code", "flow_code")

    def scope() -> Scope:
        start = date(2000 + pick.randrange(10), 1 + pick.randrange(12), 1)
        codes = {c: (f"{c[0]}{pick.randrange(8)}",) for c in keys if pick.random() < 0.8}
        return Scope(start, date(start.year + pick.randrange(2), 12, 1), codes)

    scopes = [scope() for _ in range(40)]
    held = scope_table(spark, scopes * 60, keys)  # 2,400 rows, repeated ones included

    def covered(row) -> bool:
        month, values = row[0], dict(zip(keys, row[1:4]))
        return any(s.start <= month <= s.end and all(values[c] in codes for c, codes in s.keys.items()) for s in scopes)

    expected = {r[4] for r in rows if covered(r)}
    assert {r.n for r in inside_scopes(frame, held, keys).collect()} == expected
    kept = outside_scopes(frame, held, keys)
    assert {r.n for r in kept.collect()} == {r[4] for r in rows} - expected
    few = outside_scopes(frame, scope_table(spark, scopes, keys), keys)
    size = lambda f: f._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(kept) == size(few)


def test_scope_table_edges(spark):
    cells = cell_frame(spark)
    everything = scope_table(spark, [Scope(date(2000, 1, 1), date(2030, 1, 1), {})], KEYS)
    assert outside_scopes(cells, everything, KEYS).count() == 0
    unknown = cells.withColumn("period_month", F.lit(None).cast("date"))
    assert outside_scopes(unknown, everything, KEYS).count() == 18
    assert inside_scopes(cells.limit(0), everything, KEYS).count() == 0
    no_code = scope_table(spark, [Scope(DEC, JAN, {"product_code": ()})], KEYS)
    assert outside_scopes(cells, no_code, KEYS).count() == 18
    wrong = everything.withColumn("end_month", F.lit(date(1999, 1, 1)))
    assert unordered_scopes(wrong).count() == 1
    with pytest.raises(ValueError, match="ordered"):
        replace_rows_by_table(cells, cells, wrong, KEYS)
    with pytest.raises(ValueError, match="undeclared"):
        scope_table(spark, [Scope(DEC, JAN, {"colour": ("red",)})], KEYS)
    with pytest.raises(ValueError, match="incompatible"):
        replace_rows_by_table(cells, cells.drop("source_status"), everything, KEYS)
    twice = cells.unionByName(cells)
    with pytest.raises(ValueError, match="repeats"):
        replace_rows_by_table(cells, twice, everything, KEYS, unique=contracts.TRADE_KEY)


def test_table_is_replaced_by_a_scope_table(spark, tmp_path):
    first, second = cell_frame(spark), cell_frame(spark, REVISED, "capture-b")
    path = str(tmp_path / "cells")
    publish.write_month_table(first, path)
    held = scope_table(spark, SCOPES, KEYS)
    publish.replace_in_table_by(spark, path, second, held, KEYS, "monthly_trade", key=contracts.TRADE_KEY)
    assert row_differences(tables.read_table(spark, path, "monthly_trade"), replace_rows(first, second, SCOPES)).count() == 0


MAPPING = "product_code string, product_group string, valid_from_year int, valid_to_year int"
REQUEST = (
    "request_id string, reporter_code string, start_month date, end_month date, products array<string>, "
    "product_groups array<string>, flows array<string>"
)
SLICE = "slice_id string, reporter_code string, start_month date, end_month date, products array<string>, partners array<string>"


def test_groups_become_scopes_inside_their_years(spark):
    mapping = spark.createDataFrame([("a", "g", 2017, 2021), ("b", "g", 2022, 2026), ("c", "h", 2017, 2026)], MAPPING)
    ask = spark.createDataFrame([("q", "DE", DEC, JAN, ["c"], ["g", "h"], ["1"]), ("none", "DE", DEC, JAN, None, None, ["1"])], REQUEST)
    leaves = selection.requested_leaves(ask, mapping)
    assert sorted((r.product_code, r.period_month) for r in leaves.collect()) == [("a", DEC), ("b", JAN), ("c", DEC), ("c", JAN)]
    slices = [("s1", "DE", date(2021, 1, 1), DEC, ["a", "b", "c"], ["BR", "QS"]), ("s2", "DE", JAN, JAN, ["b", "c"], ["BR"])]
    scopes = selection.selected_scopes(leaves, spark.createDataFrame(slices, SLICE))
    rows = {(r.slice_id, r.start_month): (r.product_code, r.partner_code) for r in scopes.collect()}
    assert rows == {("s1", DEC): (["a", "c"], ["BR", "QS"]), ("s2", JAN): (["b", "c"], ["BR"])}
    assert selection.selection_problems(scopes, leaves).count() == 0
    again = spark.createDataFrame([slices[0], ("s3", "DE", DEC, DEC, ["a"], ["BR"])], SLICE)
    problems = selection.selection_problems(selection.selected_scopes(leaves, again), leaves)
    assert {(r.product_code, r.period_month, r.problem) for r in problems.collect()} == {
        ("a", DEC, "overlapping"), ("b", JAN, "missing"), ("c", JAN, "missing"),
    }
    odd = spark.createDataFrame([("q", "DE", DEC, JAN, ["z", "c"], ["g", "y"], ["1"])], REQUEST)
    assert {(r.kind, r.choice) for r in selection.unknown_choices(odd, mapping).collect()} == {("product", "z"), ("product_group", "y")}


def test_price_selection_beyond_its_captures(spark):
    ask = spark.createDataFrame(
        [("q", "prices", DEC, JAN, ["x", "y"])], "request_id string, source_dataset string, start_month date, end_month date, series array<string>"
    )
    held = spark.createDataFrame([("prices", "x", DEC, JAN), ("prices", "y", DEC, DEC)], "source_dataset string, series_id string, start_month date, end_month date")
    assert [(r.series_id, r.period_month) for r in selection.price_problems(ask, held).collect()] == [("y", JAN)]
    assert selection.price_scopes(ask).first().series_id == ["x", "y"]


def test_versions_come_from_pinned_captures(spark):
    first, second = cell_frame(spark), cell_frame(spark, REVISED, "capture-b")
    store = first.unionByName(new_captures(first, second))
    assert new_captures(store, second).count() == 0
    every = [Scope(date(2000, 1, 1), date(2030, 1, 1), {})]

    def step(number, scopes, *captures):
        held = scope_table(spark, scopes, KEYS)
        return held.withColumn("capture_ids", F.array(*[F.lit(c) for c in captures])).withColumn("selection_no", F.lit(number).cast("long"))

    selections = step(1, every, "capture-a").unionByName(step(2, SCOPES, "capture-b")).unionByName(step(3, SCOPES, "capture-a"))
    replaced = replace_rows(first, second, SCOPES)
    assert row_differences(version(store, selections, KEYS, 1), first).count() == 0
    assert row_differences(version(store, selections, KEYS, 2), replaced).count() == 0
    assert row_differences(version(store, selections, KEYS), first).count() == 0
    assert version(store, selections, KEYS, 0).count() == 0


def test_only_touched_blocks_are_built_again(spark):
    first, second = cell_frame(spark), cell_frame(spark, REVISED, "capture-b")
    held = scope_table(spark, SCOPES[:1], KEYS)
    after = replace_rows_by_table(first, second, held, KEYS)
    blocks = refresh.touched_blocks(first, second, held, KEYS)
    assert [r.period_month for r in blocks.collect()] == [DEC]
    mapping = dims.product_groups(spark)
    builders = refresh.trade_marts(dims.trade_product(mapping))
    before, full = refresh.trade_fact(first, mapping), refresh.trade_fact(after, mapping)
    earlier = {name: build(before) for name, build in builders.items()}
    now = refresh.refreshed_marts(earlier, after, blocks, mapping, dims.trade_product(mapping))
    assert set(now) == set(builders)
    for name, build in builders.items():
        assert row_differences(now[name], build(full)).count() == 0, name
    assert row_differences(earlier["monthly_trade_balances"], builders["monthly_trade_balances"](full)).count() > 0
    withdrawn = first.where(F.col("period_month") != DEC)
    emptied = refresh.refreshed_marts(earlier, withdrawn, blocks, mapping, dims.trade_product(mapping))
    assert emptied["monthly_partner_shares"].where(F.col("month_key") == DEC).count() == 0


def test_drift_of_files_is_reported_and_refused(spark, tmp_path):
    cells = cell_frame(spark)
    root = str(tmp_path / "cells")
    cells.write.parquet(f"{root}/a")
    assert footers.file_drift(spark, root, "monthly_trade").count() == 0
    cells.drop("source_value").withColumn("note", F.lit("x")).withColumn("classification_year", F.lit(1).cast("int")).coalesce(1).write.parquet(f"{root}/b")
    found = {(r["problem"], r["column_name"], r["declared_type"], r["found_type"], r["files"], r["affected_rows"]) for r in as_dicts(footers.file_drift(spark, root, "monthly_trade"))}
    assert found == {
        ("absent", "source_value", "decimal(24,4)", None, 1, 18),
        ("undocumented", "note", None, "string", 1, 18),
        ("wrong_type", "classification_year", "smallint", "int", 1, 18),
    }
    with pytest.raises(ValueError, match="absent source_value"):
        tables.read_table(spark, f"{root}/b", "monthly_trade")
    by_month = str(tmp_path / "run=1" / "months")
    publish.write_month_table(cells, by_month)
    assert tables.read_table(spark, by_month, "monthly_trade").count() == 18
    extra = str(tmp_path / "extra")
    cells.withColumn("zone", F.lit("z")).write.partitionBy("zone").parquet(extra)
    assert [(r["problem"], r["column_name"]) for r in as_dicts(footers.file_drift(spark, extra, "monthly_trade"))] == [("undocumented", "zone")]
    empty = str(tmp_path / "empty")
    publish.write_verified(cell_frame(spark, FIXTURE[:0]), empty)
    assert footers.file_drift(spark, empty, "monthly_trade").count() == 0
    assert cells.agg(F.sum("source_value")).first()[0] > Decimal(0)
