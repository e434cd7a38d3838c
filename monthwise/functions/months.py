"""Month arithmetic on whole numbers, so that calendar offsets are exact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_PATTERN = r"^\d{4}M(0[1-9]|1[0-2])$"


def index_of(day: date) -> int:
    """Months since year 0 of a Python date."""
    return day.year * 12 + day.month - 1


def month_index(day: Column) -> Column:
    """Months since year 0 of a date column."""
    return F.year(day) * 12 + F.month(day) - 1


def month_of_index(index: Column) -> Column:
    """First day of the month with the given index."""
    return F.make_date(
        F.floor(index / 12).cast("int"), F.pmod(index, F.lit(12)).cast("int") + 1, F.lit(1)
    )


def months_between(earlier: Column, later: Column) -> Column:
    """Month boundaries crossed from one date to the other."""
    return month_index(later) - month_index(earlier)


def first_of_month(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")


def month_spine(start: Column, end: Column) -> Column:
    """Array of month starts, both ends included; explode it for rows."""
    return F.sequence(start, end, F.expr("interval 1 month"))


def parse_period(text: Column) -> Column:
    """``YYYYMmm`` to a month start; anything else is null."""
    year = F.substring(text, 1, 4).cast("int")
    month = F.substring(text, 6, 2).cast("int")
    return F.when(text.rlike(PERIOD_PATTERN), F.make_date(year, month, F.lit(1)))


def parse_update_label(text: Column) -> Column:
    """``Updated on <Month d, yyyy>`` to a date, or null."""
    return F.try_to_timestamp(text, F.lit("'Updated on 'MMMM d, yyyy")).cast("date")


def age_in_months(observed: Column, now: date) -> Column:
    """Calendar months between an observation and the evaluation date."""
    return (F.lit(index_of(now)) - month_index(observed)).cast("long")
