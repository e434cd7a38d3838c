"""Decimal parsing and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even_decimal(text: Column, precision: int, scale: int, below: str) -> Column:
    """Text to decimal, ties to the even digit; null when not a finite number under ``below``."""
    # The cast rounds past 18 digits, which must not happen twice: the 18th says whether anything is left beyond 17.
    beyond = F.regexp_extract(text, r"\.\d{17}(\d+)", 1)
    short = F.concat(F.regexp_extract(text, r"^\s*([+-]?\d*\.\d{17})", 1), F.when(beyond.rlike("[1-9]"), "1").otherwise("0"))
    wide = F.when(text.rlike(r"^\s*[+-]?\d*\.\d{19,}\s*$"), short).otherwise(text).try_cast("decimal(38,18)")
    rounded = F.bround(wide, scale)
    limit = F.lit(below).cast("decimal(38,0)")
    return F.when(F.abs(rounded) < limit, rounded.try_cast(f"decimal({precision},{scale})"))


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient; null when either side is null or the divisor is zero.

    Both sides are cast first: decimal division in Spark keeps a fixed scale and
    loses digits.
    """
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def as_amount(value: Column) -> Column:
    """Published money and mass totals carry 38 digits, four of them decimal."""
    return value.cast("decimal(38,4)")
