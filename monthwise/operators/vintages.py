"""Versions of a table out of an append-only store of captured rows.

Rows of every capture are appended once and never changed.  A selection pins captures for a scope; selections are
numbered, and a later one takes over the months and codes that it covers.  A version is what the selections up to a
number leave visible, so an older state is read, or pinned again, without copying rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.operators.scope_tables import SALTS, _lists, _salted, covered_months, listed_columns, salts_for


def new_captures(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows of captures that the store does not hold yet; appending them again adds nothing."""
    return incoming.join(store.select("source_capture_id").distinct(), "source_capture_id", "left_anti").select(store.columns)


def version(
    store: DataFrame,
    selections: DataFrame,
    keys: Sequence[str],
    number: int | None = None,
    month: str = "period_month",
    salts: int = SALTS,
) -> DataFrame:
    """Rows of the store that the selections up to ``number`` (all by default) leave visible.

    ``selections`` is a scope table with selection_no bigint and capture_ids array.  Of the selections that cover a
    row the one with the largest number decides: the row is visible if its capture is pinned there.  Several rows
    of one number are one selection whose scopes may pin captures of their own.
    """
    if number is not None:
        selections = selections.where(F.col("selection_no") <= number)
    rows, latest = store, []
    for n, listed in enumerate(listed_columns(selections, keys)):
        dealt = salts_for(listed, keys, salts)
        scoped = covered_months(selections.where(_lists(keys, listed)), "selection_no", *listed, month=month)
        for column in listed:
            scoped = scoped.withColumn(column, F.explode(column))
        last = scoped.groupBy(month, *listed).agg(F.max("selection_no").alias(f"__latest_{n}"))
        last = last.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(dealt - 1).cast("long"))))
        rows = _salted(rows, listed, month, dealt).join(last, [month, *listed, "__salt"], "left").drop("__salt")
        latest.append(F.col(f"__latest_{n}"))
    if not latest:
        return store.limit(0)
    decided = rows.withColumn("__selection", F.greatest(*latest) if len(latest) > 1 else latest[0])
    pinned = selections.select(
        F.col("selection_no").alias("__selection"), F.explode("capture_ids").alias("source_capture_id")
    ).distinct()
    return decided.join(pinned, ["__selection", "source_capture_id"], "left_semi").select(store.columns)
