"""Series on a complete month axis.

One grouped pass per series puts every month of an interval in a row, represented or
not.  Rows then stay hash-partitioned by series, so each later window over a series
sorts inside its task and moves nothing.  A series never holds more rows than the
interval has months.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from monthwise.functions.months import index_of, month_index


def on_month_axis(
    rows: DataFrame,
    keys: Sequence[str],
    month: str,
    values: Sequence[str],
    first: date,
    last: date,
) -> DataFrame:
    """Keys, ``m`` (month index), ``represented`` and the values, for every month.

    Months that the source lacks have null values: nothing is filled.  A month that
    occurs twice in a series fails the job (duplicate map key).
    """
    entry = F.struct(month_index(F.col(month)), F.struct(*values))
    by_month = F.map_from_entries(F.collect_list(entry))
    return (
        rows.where(F.col(month).between(F.lit(first), F.lit(last)))
        .groupBy(*keys)
        .agg(by_month.alias("by_month"))
        .select(
            *keys,
            "by_month",
            F.explode(F.sequence(F.lit(index_of(first)), F.lit(index_of(last)))).alias("m"),
        )
        .withColumn("row", F.try_element_at("by_month", F.col("m")))
        .select(*keys, "m", F.col("row").isNotNull().alias("represented"), "row.*")
    )


def along(keys: Sequence[str]) -> WindowSpec:
    """A series in month order."""
    return Window.partitionBy(*keys).orderBy("m")


def at_offset(value: Column, months: int, window: WindowSpec) -> Column:
    """The value exactly ``months`` later (earlier when negative) on a complete axis."""
    if months == 0:
        return value
    return F.lead(value, months).over(window) if months > 0 else F.lag(value, -months).over(window)


def trailing_count(value: Column, months: int, window: WindowSpec) -> Column:
    """Non-null values in the ``months`` months that end at the row."""
    return F.count(value).over(window.rangeBetween(-(months - 1), 0))


def count_until(flag: Column, lag_months: int, window: WindowSpec) -> Column:
    """How many rows up to ``lag_months`` months earlier satisfy a flag."""
    hits = F.count_if(flag).over(window.rangeBetween(Window.unboundedPreceding, -lag_months))
    return F.coalesce(hits, F.lit(0).cast("long"))


def run_id(observed: Column, window: WindowSpec) -> Column:
    """Number of gaps so far: constant along a run of observed months."""
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.count_if(~observed).over(upto)
