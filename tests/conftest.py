import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from monthwise import contracts  # noqa: E402
from monthwise.plans import dims, facts, staging  # noqa: E402
from monthwise.session import local_session  # noqa: E402

VALUE, MASS = "VALUE_IN_EUROS", "QUANTITY_IN_100KG"

# month, partner, product, flow, value, quantity in 100 kg, quantity status
FIXTURE = (
    ("2021-12-01", "BR", "09011100", "1", "1000", "5.5", None),
    ("2021-12-01", "QS", "09011100", "2", "200", "0", None),
    ("2021-12-01", "WORLD", "09011100", "1", "1300", "7", None),
    ("2021-12-01", "WORLD", "09011100", "2", "250", "1", None),
    ("2021-12-01", "BR", "18069090", "1", "300", None, "u"),
    ("2022-01-01", "BR", "09011100", "1", "1100", "6", None),
    ("2022-01-01", "WORLD", "09011100", "1", "1400", "8", None),
    ("2022-01-01", "BR", "18069090", "1", "320", "2", None),
    ("2022-01-01", "WORLD", "18069090", "1", "500", "3", None),
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8", "6g",
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def cell_rows(records=FIXTURE, capture="capture-a"):
    rows = []
    for month, partner, product, flow, value, mass, status in records:
        day = date.fromisoformat(month)
        for indicator, number, mark in ((VALUE, value, None), (MASS, mass, status)):
            rows.append(
                (
                    "trade", "M", "DE", partner, f"Label {partner}", product, flow, indicator, day,
                    number, None if number is None else Decimal(number), mark,
                    day.year == 2021, "CN", day.year, capture, "2026-08-14T11:00:00+0200",
                )
            )
    return rows


def cell_frame(spark, records=FIXTURE, capture="capture-a"):
    return spark.createDataFrame(cell_rows(records, capture), contracts.schema("monthly_trade"))


def staged_frame(spark, cells):
    return staging.trade_observations(cells, dims.product_groups(spark))


def fact_frame(spark, cells):
    return facts.trade_observations(facts.paired_measures(staged_frame(spark, cells)))


def as_dicts(frame, *order):
    rows = [r.asDict() for r in frame.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
