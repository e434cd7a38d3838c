import json
from datetime import date
from decimal import Decimal

import pytest

from monthwise.plans import coverage
from monthwise.sources import cubes
from tests.conftest import FIXTURE, VALUE, MASS, as_dicts

PARTNERS, PRODUCTS, FLOWS = ("BR", "QS", "WORLD"), ("09011100", "18069090"), ("1", "2")


def document(month="2021-12", dense=False, listed=False, with_status=True, **changes):
    """A cube of the fixture's cells of one month."""
    values, statuses = {}, {}
    for day, partner, product, flow, value, mass, status in FIXTURE:
        if day[:7] != month:
            continue
        for n, (number, mark) in enumerate(((value, None), (mass, status))):
            at = ((PARTNERS.index(partner) * 2 + PRODUCTS.index(product)) * 2 + FLOWS.index(flow)) * 2 + n
            if number is not None:
                values[at] = number
            if mark is not None:
                statuses[at] = mark

    def category(codes, labels=False):
        index = list(codes) if listed else {c: n for n, c in enumerate(codes)}
        return {"category": {"index": index, "label": {c: f"Label {c}" for c in codes} if labels else {}}}

    result = {
        "class": "dataset", "version": "2.0", "id": list(cubes.DIMENSIONS), "size": [1, 1, 3, 2, 2, 2, 1],
        "updated": "2026-08-14T11:00:00+0200",
        "dimension": {
            "freq": category(["M"]), "reporter": category(["DE"]), "partner": category(PARTNERS, True),
            "product": category(PRODUCTS), "flow": category(FLOWS), "indicators": category([VALUE, MASS]),
            "time": category([month]),
        },
        "value": "@value@",
    }
    if with_status:
        result["status"] = [statuses.get(n) for n in range(24)] if dense else {str(k): v for k, v in statuses.items()}
    result.update(changes)
    if dense:
        body = "[" + ", ".join(values.get(n, "null") for n in range(24)) + "]"
    else:
        body = "{" + ", ".join(f'"{k}": {v}' for k, v in values.items()) + "}"
    return json.dumps(result).replace('"@value@"', body)


def parsed(spark, *texts, requests=None):
    frame = spark.createDataFrame([(f"d{n}", t) for n, t in enumerate(texts)], "document_id string, content string")
    return cubes.parse_documents(frame, requests)


@pytest.mark.parametrize("dense, listed", [(False, False), (True, True)])
def test_decode(spark, dense, listed):
    frame = cubes.decode_cells(parsed(spark, document(dense=dense, listed=listed)), "trade").cache()
    rows = {(r["partner_code"], r["product_code"], r["flow_code"], r["indicator_code"]): r for r in as_dicts(frame)}
    assert len(rows) == 10
    assert rows[("BR", "09011100", "1", VALUE)]["source_value"] == Decimal("1000.0000")
    assert rows[("BR", "09011100", "1", MASS)]["source_value_text"] == "5.5"
    unavailable = rows[("BR", "18069090", "1", MASS)]
    assert unavailable["source_value"] is None and unavailable["source_status"] == "u"
    assert rows[("QS", "09011100", "2", MASS)]["source_value"] == 0
    assert rows[("WORLD", "09011100", "1", VALUE)]["partner_label"] == "Label WORLD"
    assert rows[("WORLD", "09011100", "1", VALUE)]["period_month"] == date(2021, 12, 1)
    stats = as_dicts(coverage.slice_statistics(frame))[0]
    assert (stats["represented_cell_count"], stats["value_cell_count"]) == (10, 9)
    assert (stats["status_cell_count"], stats["explicit_zero_count"]) == (1, 1)
    series = {(r["partner_code"], r["product_code"]): r for r in as_dicts(coverage.series_coverage(frame))}
    chocolate = series[("BR", "18069090")]
    assert chocolate["last_value_month"] == date(2021, 12, 1)
    assert chocolate["last_quantity_month"] is None and chocolate["last_paired_month"] is None


def test_digits_survive(spark):
    text = document().replace('"0": 1000', '"0": 12345678901234567.12345')
    row = as_dicts(cubes.decode_cells(parsed(spark, text), "t").where(f"partner_code = 'BR' and product_code = '09011100' and indicator_code = '{VALUE}'"))[0]
    assert row["source_value_text"] == "12345678901234567.12345"
    assert row["source_value"] == Decimal("12345678901234567.1234")


def test_missing_status_is_not_an_empty_status(spark):
    rows = as_dicts(cubes.decode_cells(parsed(spark, document("2022-01", with_status=False)), "t"))
    assert {r["status_available"] for r in rows} == {False}
    rows = as_dicts(cubes.decode_cells(parsed(spark, document("2022-01")), "t"))
    assert {r["status_available"] for r in rows} == {True}


def test_explicit_empty_value_is_valid(spark):
    frame = parsed(spark, document(value={}, status={}))
    assert cubes.document_violations(frame).count() == 0
    assert cubes.decode_cells(frame, "t").count() == 0


@pytest.fixture(scope="module")
def broken(spark):
    good = document()
    cases = {
        "missing_values": document(value=None),
        "unsupported_envelope": document(version="1.0"),
        "unexpected_dimensions": document(id=["reporter", "freq", *cubes.DIMENSIONS[2:]]),
        "size_mismatch": document(size=[1, 1, 4, 2, 2, 2, 1]),
        "invalid_sizes": document(size=[1, 1, 0, 2, 2, 2, 1]),
        "positions_not_contiguous": good.replace('"QS": 1', '"QS": 5'),
        "missing_partner_labels": good.replace('"QS": "Label QS", ', ""),
        "missing_update_time": document(updated=""),
        "invalid_values": good.replace('"0": 1000', '"99": 1000'),
        "invalid_status": document(status={"5": None}),
        "null in sparse": good.replace('"0": 1000', '"0": null'),
        "text": good.replace('"0": 1000', '"0": "1000"'),
        "boolean": good.replace('"0": 1000', '"0": true'),
        "too large": good.replace('"0": 1000', '"0": 100000000000000000000'),
        "short list": document(dense=True).replace("1000, ", "", 1),
        "not json": good[:-10],
    }
    rows = [(name, text) for name, text in cases.items()]
    frame = spark.createDataFrame(rows, "document_id string, content string")
    found = {}
    for r in as_dicts(cubes.document_violations(cubes.parse_documents(frame))):
        found.setdefault(r["document_id"], set()).add(r["rule"])
    assert cubes.decode_cells(cubes.parse_documents(frame), "t").count() == 0
    return found


@pytest.mark.parametrize(
    "case, rule",
    [
        (name, name)
        for name in (
            "missing_values", "unsupported_envelope", "unexpected_dimensions", "size_mismatch", "invalid_sizes",
            "positions_not_contiguous", "missing_partner_labels", "missing_update_time", "invalid_values",
            "invalid_status",
        )
    ]
    + [(name, "invalid_values") for name in ("null in sparse", "text", "boolean", "too large", "short list")]
    + [("not json", "unsupported_envelope")],
)
def test_broken_documents_are_reported(broken, case, rule):
    assert rule in broken[case]


def test_scope_must_match_the_request(spark):
    schema = (
        "document_id string, reporters array<string>, products array<string>, flows array<string>, "
        "indicators array<string>, months array<string>, partners array<string>"
    )
    exact = ("d0", ["DE"], ["18069090", "09011100"], ["1", "2"], [VALUE, MASS], ["2021-12"], list(PARTNERS))
    other = ("d1", ["DE"], ["09011100"], ["1", "2"], [VALUE, MASS], ["2021-11"], ["BR", "WORLD"])
    frame = parsed(
        spark, document(), document(), document(), requests=spark.createDataFrame([exact, other], schema)
    )
    found = {(r["document_id"], r["rule"]) for r in as_dicts(cubes.document_violations(frame))}
    assert found == {
        ("d1", "unexpected_product_scope"), ("d1", "unexpected_time_scope"),
        ("d1", "unexpected_partner_scope"), ("d2", "not_requested"),
    }


def test_requested_series_that_never_appear_are_counted(spark):
    cells = cubes.decode_cells(parsed(spark, document(), document("2022-01")), "trade")
    observed = coverage.series_coverage(cells)
    requests = spark.createDataFrame(
        [("trade", "DE", [*PARTNERS, "INT_EU"], list(PRODUCTS), list(FLOWS))],
        "source_dataset string, reporter_code string, partners array<string>, products array<string>, flows array<string>",
    )
    rows = {
        (r["product_code"], r["flow_code"], r["layer"]): r
        for r in as_dicts(coverage.trade_freshness(requests, observed, date(2022, 3, 1)))
    }
    assert {layer for _, _, layer in rows} == {"world", "detail", "special", "aggregate"}
    empty = rows[("09011100", "1", "aggregate")]
    assert (empty["requested_series"], empty["series_with_paired_observations"]) == (1, 0)
    assert empty["series_at_latest_month"] == 0 and empty["observed_age_months"] is None
    world = rows[("09011100", "1", "world")]
    assert world["observed_age_months"] == 2 and world["series_at_latest_month"] == 1
