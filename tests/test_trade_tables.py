from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.operators import quality
from monthwise.plans import checks, dims, facts, marts, presentation
from tests.conftest import FIXTURE, cell_frame, fact_frame, as_dicts, staged_frame

DEC, JAN = date(2021, 12, 1), date(2022, 1, 1)


@pytest.fixture(scope="module")
def cells(spark):
    return cell_frame(spark)


@pytest.fixture(scope="module")
def fact(spark, cells):
    return fact_frame(spark, cells).cache()


def test_staging_classes_units_and_segments(spark, cells):
    rows = {
        (r["period_month"], r["partner_code"], r["product_code"], r["flow_code"], r["indicator_code"]): r
        for r in as_dicts(staged_frame(spark, cells))
    }
    assert len(rows) == 18
    brazil = rows[(DEC, "BR", "09011100", "1", "QUANTITY_IN_100KG")]
    assert brazil["normalized_value"] == Decimal("550.0000")
    assert (brazil["partner_class"], brazil["normalized_unit"]) == ("named", "kg")
    assert rows[(DEC, "QS", "09011100", "2", "VALUE_IN_EUROS")]["partner_class"] == "special"
    world = rows[(DEC, "WORLD", "09011100", "1", "VALUE_IN_EUROS")]
    assert world["partner_class"] == "aggregate" and world["is_partner_detail"] is False
    missing = rows[(DEC, "BR", "18069090", "1", "QUANTITY_IN_100KG")]
    assert missing["source_value"] is None and missing["source_status"] == "u"
    assert missing["comparability_segment"] == "2017-2021"
    later = rows[(JAN, "BR", "18069090", "1", "QUANTITY_IN_100KG")]
    assert later["comparability_segment"] == "2022-2026"


def test_mapping_is_valid_only_inside_its_years(spark, cells):
    narrow = dims.product_groups(spark).withColumn("valid_to_year", F.lit(2021))
    from monthwise.plans import staging

    groups = staging.trade_observations(cells, narrow).select("period_month", "product_group").distinct()
    found = {(r[0], r[1]) for r in groups.collect()}
    assert (JAN, None) in found and (DEC, "coffee_unroasted") in found
    assert not any(month == JAN and group for month, group in found)


def test_zero_mass_is_numeric_without_unit_value(fact):
    row = as_dicts(fact.where("partner_code = 'QS'"))[0]
    assert row["trade_value_eur"] == 200 and row["net_mass_kg"] == 0
    assert row["has_paired_measures"] and row["unit_value_eur_per_kg"] is None
    assert row["value_basis"] == "FOB"


def test_facts_grain_and_keys(fact):
    assert fact.count() == 9
    row = as_dicts(fact.where("partner_code = 'BR' and product_code = '18069090' and month_key = '2021-12-01'"))[0]
    assert row["trade_observation_key"] == "trade:DE:BR:18069090:2021:1:2021-12-01"
    assert row["trade_product_key"] == "18069090:2021" and row["commodity_key"] == "cocoa"
    assert row["quantity_cell_present"] and not row["has_numeric_mass"]


def test_product_metrics(spark, fact):
    rows = as_dicts(
        marts.product_metrics(fact, dims.trade_product(dims.product_groups(spark))),
        "month_key", "product_group", "flow_name",
    )
    found = [
        (
            r["month_key"], r["product_group"], r["flow_name"], int(r["world_value_eur"]),
            int(r["world_net_mass_kg"]), r["observed_unit_value_eur_per_kg"], r["observed_product_value_share"],
        )
        for r in rows
    ]
    assert found == [
        (DEC, "coffee_unroasted", "exports", 250, 100, 2.5, 1.0),
        (DEC, "coffee_unroasted", "imports", 1300, 700, 13 / 7, 1.0),
        (JAN, "chocolate_cocoa_preparations", "imports", 500, 300, 5 / 3, 5 / 19),
        (JAN, "coffee_unroasted", "imports", 1400, 800, 1.75, 14 / 19),
    ]
    assert rows[0]["universe_expected_product_count"] == 33
    assert rows[0]["universe_observed_value_product_count"] == 1
    assert rows[0]["has_complete_product_mix_universe"] is False
    assert rows[2]["contains_scope_break"] is True


def test_balances_need_identical_leaves(fact):
    rows = as_dicts(marts.trade_balances(fact), "month_key", "product_group")
    found = [
        (
            r["month_key"], r["product_group"], r["import_value_cif_eur"], r["export_value_fob_eur"],
            r["has_compatible_flow_coverage"], r["trade_balance_eur"],
        )
        for r in rows
    ]
    assert found == [
        (DEC, "coffee_unroasted", 1300, 250, True, -1050),
        (JAN, "chocolate_cocoa_preparations", 500, None, False, None),
        (JAN, "coffee_unroasted", 1400, None, False, None),
    ]


def test_concentration(fact):
    rows = as_dicts(marts.partner_concentration(fact), "month_key", "product_group", "flow_name")
    first, second, *rest = rows
    assert first["named_partner_value_eur"] == 300 and first["named_partner_hhi"] == 1.0
    assert first["world_value_eur"] is None and first["reconciliation_status"] == "WORLD unavailable"
    assert second["named_partner_value_eur"] is None and second["named_partner_count"] == 0
    assert second["observed_special_value_eur"] == 200 and second["world_value_eur"] == 250
    assert second["reconciliation_residual_eur"] == 50
    assert second["reconciliation_status"] == "partial WORLD coverage"
    assert [int(r["reconciliation_residual_eur"]) for r in rest] == [300, 180, 300]


def test_index_is_the_sum_of_squared_shares(spark):
    records = [
        ("2021-12-01", code, "09011100", "1", value, "1", None)
        for code, value in (("BR", "600"), ("VN", "300"), ("CI", "100"))
    ]
    fact = fact_frame(spark, cell_frame(spark, records))
    row = as_dicts(marts.partner_concentration(fact))[0]
    assert row["named_partner_hhi"] == pytest.approx(0.36 + 0.09 + 0.01)
    assert row["largest_named_partner_share"] == pytest.approx(0.6)
    shares = as_dicts(marts.partner_shares(fact), "named_partner_rank")
    assert [r["partner_code"] for r in shares] == ["BR", "VN", "CI"]
    assert as_dicts(marts.top_partners(fact))[0]["partner_code"] == "BR"


def test_zero_denominator_has_no_share(spark):
    fact = fact_frame(spark, cell_frame(spark, [("2022-01-01", "BR", "09011100", "1", "0", "1", None)]))
    row = as_dicts(marts.partner_shares(fact))[0]
    assert row["partner_value_eur"] == 0 and row["named_partner_denominator_eur"] == 0
    assert row["named_partner_value_share"] is None
    assert row["has_positive_named_denominator"] is False
    block = as_dicts(marts.partner_concentration(fact))[0]
    assert block["named_partner_hhi"] is None and block["named_partner_count"] == 1


def test_unmapped_products_keep_context_but_no_named_figures(spark):
    fact = fact_frame(spark, cell_frame(spark, [("2022-01-01", "BR", "99999999", "1", "10", "1", None)]))
    row = as_dicts(marts.partner_concentration(fact))[0]
    assert row["product_group"] is None and row["named_partner_count"] == 0
    assert row["named_partner_value_eur"] is None and row["named_product_coverage"] == "99999999"


def test_ties_rank_by_partner_code(spark):
    records = [("2021-12-01", c, "09011100", "1", "5", "1", None) for c in ("VN", "BR", "CI")]
    fact = fact_frame(spark, cell_frame(spark, records))
    ranked = as_dicts(marts.partner_shares(fact), "named_partner_rank")
    assert [r["partner_code"] for r in ranked] == ["BR", "CI", "VN"]
    assert as_dicts(marts.top_partners(fact))[0]["partner_code"] == "BR"


def test_dimensions(spark, cells):
    assert dims.calendar(spark).count() == 140
    products = dims.trade_product(dims.product_groups(spark))
    assert products.count() == 330
    assert products.where("has_scope_break").count() == 10
    keys = {r[0] for r in products.select("commodity_key").distinct().collect()}
    assert keys == {"coffee", "cocoa"}
    assert dims.commodity(spark).count() == 2
    relabeled = cells.unionByName(
        cells.where("partner_code = 'BR'").withColumn("partner_label", F.lit("A label"))
    )
    partner = as_dicts(dims.trade_partner(staged_frame(spark, relabeled)).where("partner_code = 'BR'"))[0]
    assert partner["label_count"] == 2 and partner["partner_label"] == "A label"
    assert partner["trade_partner_key"] == "trade:DE:BR"


def test_governance_checks_pass_and_fail(spark, cells, fact):
    staged = staged_frame(spark, cells)
    products = dims.trade_product(dims.product_groups(spark))
    totals = checks.fact_totals(staged, fact, products, dims.trade_partner(staged))
    assert checks.fact_preservation(totals).count() == 0
    row = as_dicts(totals)[0]
    assert row["expected_fact_count"] == row["fact_count"] == row["joined_count"] == 9
    twice = products.unionByName(products.where("product_code = '09011100'"))
    assert checks.fact_preservation(
        checks.fact_totals(staged, fact, twice, dims.trade_partner(staged))
    ).count() == 1
    assert {r["violations"] for r in as_dicts(checks.staging_semantics(staged))} == {0}
    broken = staged.withColumn("source_unit", F.lit("t"))
    counts = {r["check_name"]: r["violations"] for r in as_dicts(checks.staging_semantics(broken))}
    assert counts["value_units"] == 9 and counts["mass_units"] == 9
    assert checks.scope_break_labels(fact).count() == 0
    assert checks.mapping_shape(dims.product_groups(spark), 33, 2017, 2026).count() == 0
    assert checks.mapping_shape(dims.product_groups(spark), 32, 2017, 2026).count() == 1
    tallies = checks.metric_invariants(
        fact, marts.partner_shares(fact), marts.product_metrics(fact, products),
        marts.trade_balances(fact), marts.partner_concentration(fact),
    )
    assert {r["violations"] for r in as_dicts(tallies)} == {0}


def test_key_conflicts(spark):
    rows = cell_frame(spark, FIXTURE[:2])
    same = rows.unionByName(rows.where("partner_code = 'BR'"))
    kinds = {r["kind"] for r in as_dicts(quality.key_conflicts(same, contracts.TRADE_KEY))}
    assert kinds == {"duplicate"}
    changed = rows.where("partner_code = 'QS'").withColumn("source_capture_id", F.lit("other"))
    kinds = {r["kind"] for r in as_dicts(quality.key_conflicts(rows.unionByName(changed), contracts.TRADE_KEY))}
    assert kinds == {"conflicting"}
    assert quality.repeated_keys(rows, contracts.TRADE_KEY).count() == 0


def test_relationship_accepted_and_null_checks(spark, fact):
    products = dims.trade_product(dims.product_groups(spark))
    assert quality.orphans(fact, "trade_product_key", products, "trade_product_key").count() == 0
    fewer = products.where("product_code <> '18069090'")
    lost = as_dicts(quality.orphans(fact, "trade_product_key", fewer, "trade_product_key"), "key")
    assert [(r["key"], r["violations"]) for r in lost] == [("18069090:2021", 1), ("18069090:2022", 2)]
    assert quality.unaccepted(fact, "flow_code", ("1", "2")).count() == 0
    nulls = {r["column_name"]: r["violations"] for r in as_dicts(quality.null_counts(fact, ["net_mass_kg", "flow_code"]))}
    assert nulls == {"net_mass_kg": 1, "flow_code": 0}


def test_contract_drift_is_reported(spark, fact):
    drift = contracts.schema_drift(
        fact.withColumn("extra", F.lit(1)).drop("flow_name").withColumn("net_mass_kg", F.lit("x")),
        "fct_trade_observations",
    )
    assert drift == {"undocumented": ["extra"], "absent": ["flow_name"], "wrong_types": ["net_mass_kg"]}
    with pytest.raises(ValueError):
        contracts.conform(fact.drop("flow_name"), "fct_trade_observations")
    rows = contracts.schema_drift_rows({"fct_trade_observations": fact.drop("flow_name")}, spark)
    assert [tuple(r) for r in rows.collect()] == [("fct_trade_observations", "absent", "flow_name")]


def test_metric_dictionary(spark):
    frame = contracts.metric_dictionary(spark)
    names = [r[0] for r in frame.select("metric_name").collect()]
    assert len(names) == 8 and names == sorted(names)
    assert contracts.metric_dictionary(spark, ()).count() == 0


def test_presentation_cuts(spark, fact):
    balances = marts.trade_balances(fact)
    assert presentation.valid_balances(balances).count() == 1
    assert as_dicts(presentation.balance_validity(balances))[0]["balance_rows"] == 3
    metrics = marts.product_metrics(fact, dims.trade_product(dims.product_groups(spark)))
    assert as_dicts(presentation.mix_completeness(metrics))[0]["incomplete_mix_rows"] == 4
    assert presentation.named_concentration(marts.partner_concentration(fact)).count() == 4


def test_pivot_shuffles_once_and_prunes(fact, spark, cells):
    plan = facts.paired_measures(staged_frame(spark, cells))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
