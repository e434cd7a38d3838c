import hashlib

import pytest

from monthwise import contracts
from monthwise.plans import publish, staging
from monthwise.plans.coverage import mixed_updates, slice_statistics
from monthwise.sources import tables
from tests.conftest import FIXTURE, as_dicts, cell_frame


def test_mapping_codes_stay_text(spark, tmp_path):
    path = tmp_path / "groups.csv"
    path.write_text(
        "product_code,product_group,valid_from_year,valid_to_year\n09011100,coffee_unroasted,2017,2026\n"
    )
    row = as_dicts(tables.read_mapping(spark, str(path)))[0]
    assert row["product_code"] == "09011100" and row["valid_to_year"] == 2026


def test_captures_are_named_by_their_content(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"x": 1}')
    row = as_dicts(tables.read_captures(spark, str(tmp_path)))[0]
    assert row["source_capture_id"] == hashlib.sha256(b'{"x": 1}').hexdigest()
    assert row["content"] == '{"x": 1}'


def test_tables_are_read_with_their_contract(spark, tmp_path):
    path = str(tmp_path / "cells")
    publish.write_verified(cell_frame(spark), path)
    assert tables.read_table(spark, path, "monthly_trade").count() == 18
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        publish.write_verified(cell_frame(spark), path)


def test_slices_combine_and_report_mixed_updates(spark, tmp_path):
    parts = [cell_frame(spark, FIXTURE[:4], "a"), cell_frame(spark, FIXTURE[4:], "b")]
    combined = staging.combine_slices(parts)
    assert combined.count() == 18 and mixed_updates(combined).count() == 0
    later = parts[1].withColumn("source_update_time", contracts.F.lit("2026-09-01T00:00:00+0000"))
    assert mixed_updates(staging.combine_slices([parts[0], later])).count() == 1
    audit = str(tmp_path / "audit")
    for _ in range(2):
        publish.write_slice_audit(slice_statistics(combined), audit)
    assert spark.read.parquet(audit).count() == 4
