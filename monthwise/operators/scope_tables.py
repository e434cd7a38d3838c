"""Scopes held as a table: any number of replaced parts under a plan of fixed size.

A scope table has one row per scope: start_month, end_month and, for each key column, an array of codes or
null for every code.  Literal scopes (``operators.scope``) grow the plan by one test each; here the scopes
become distinct (month, code, ...) keys that the rows are joined with.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.operators.quality import repeated_keys
from monthwise.operators.scope import Scope

#: Rows of one month and one set of codes are dealt to this many tasks, so that a month or code with a third of all rows
#: is not one task. Keys that list every column stand for a few rows each and are not repeated.
SALTS = 16


def salts_for(listed: Sequence[str], keys: Sequence[str], salts: int) -> int:
    return 1 if len(listed) == len(keys) else salts


def scope_table(spark: SparkSession, scopes: Iterable[Scope], keys: Sequence[str]) -> DataFrame:
    """Literal scopes as a scope table."""
    rows = []
    for scope in scopes:
        unknown = set(scope.keys) - set(keys)
        if unknown:
            raise ValueError(f"scope on undeclared columns: {sorted(unknown)}")
        rows.append((scope.start, scope.end, *[list(scope.keys[k]) if k in scope.keys else None for k in keys]))
    columns = ", ".join(f"{k} array<string>" for k in keys)
    return spark.createDataFrame(rows, f"start_month date, end_month date, {columns}")


def unordered_scopes(scopes: DataFrame) -> DataFrame:
    """Scopes whose bounds are absent or out of order; a replacement refuses them."""
    return scopes.where(F.coalesce(F.col("start_month") > F.col("end_month"), F.lit(True)))


def listed_columns(scopes: DataFrame, keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Which sets of key columns the scopes list codes for; at most 2^len(keys), read from the scope table alone."""
    every = [c for n in range(len(keys) + 1) for c in combinations(keys, n)]
    present = scopes.agg(*[F.bool_or(_lists(keys, c)).alias(str(n)) for n, c in enumerate(every)]).first()
    return [c for n, c in enumerate(every) if present[str(n)]]


def _lists(keys: Sequence[str], listed: Sequence[str]) -> Column:
    tests = [F.col(k).isNotNull() if k in listed else F.col(k).isNull() for k in keys]
    return reduce(lambda left, right: left & right, tests, F.lit(True))


def covered_months(scopes: DataFrame, *columns: str, month: str = "period_month") -> DataFrame:
    """One row per scope and month start inside its bounds, with the named columns."""
    first = F.trunc(F.add_months(F.date_sub("start_month", 1), 1), "month")
    bounded = scopes.select(first.alias("first"), "end_month", *columns).where(F.col("first") <= F.col("end_month"))
    return bounded.select(F.explode(F.sequence("first", "end_month", F.expr("interval 1 month"))).alias(month), *columns)


def scope_keys(
    scopes: DataFrame, keys: Sequence[str], listed: Sequence[str], month: str = "period_month"
) -> DataFrame:
    """Distinct (month, one code per listed column) of the scopes that list exactly these columns."""
    frame = covered_months(scopes.where(_lists(keys, listed)), *listed, month=month)
    for column in listed:
        frame = frame.withColumn(column, F.explode(column))
    return frame.distinct()


def _salted(rows: DataFrame, listed: Sequence[str], month: str, salts: int) -> DataFrame:
    others = [c for c in rows.columns if c != month and c not in listed]
    spread = F.pmod(F.xxhash64(*others), F.lit(salts)) if others and salts > 1 else F.lit(0).cast("long")
    return rows.withColumn("__salt", spread)


def _salted_keys(scopes: DataFrame, keys: Sequence[str], listed: Sequence[str], month: str, salts: int) -> DataFrame:
    return scope_keys(scopes, keys, listed, month).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )


def outside_scopes(
    rows: DataFrame, scopes: DataFrame, keys: Sequence[str], month: str = "period_month", salts: int = SALTS
) -> DataFrame:
    """Rows in no scope, one left_anti join per set of listed columns; a row with a null month or code stays."""
    for listed in listed_columns(scopes, keys):
        n = salts_for(listed, keys, salts)
        held = _salted_keys(scopes, keys, listed, month, n)
        rows = _salted(rows, listed, month, n).join(held, [month, *listed, "__salt"], "left_anti").drop("__salt")
    return rows


def inside_scopes(
    rows: DataFrame, scopes: DataFrame, keys: Sequence[str], month: str = "period_month", salts: int = SALTS
) -> DataFrame:
    """Rows in at least one scope, each once."""
    found, rest = None, rows
    for listed in listed_columns(scopes, keys):
        n = salts_for(listed, keys, salts)
        held = _salted_keys(scopes, keys, listed, month, n)
        on = [month, *listed, "__salt"]
        salted = _salted(rest, listed, month, n)
        hit = salted.join(held, on, "left_semi").select(rows.columns)
        found = hit if found is None else found.unionByName(hit)
        rest = salted.join(held, on, "left_anti").select(rows.columns)
    return rows.limit(0) if found is None else found


def replace_rows_by_table(
    previous: DataFrame,
    incoming: DataFrame,
    scopes: DataFrame,
    keys: Sequence[str],
    month: str = "period_month",
    unique: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Drop every previous row inside a scope, then add the incoming rows inside it.

    Equal to ``scope.replace_rows`` on the same scopes; months are month starts.  With ``unique`` the combined
    rows are checked, in a job of its own, and a repeated key raises.
    """
    if previous.schema.simpleString() != incoming.schema.simpleString():
        raise ValueError("incompatible normalized schema")
    if not unordered_scopes(scopes).isEmpty():
        raise ValueError("replacement bounds must be ordered")
    kept = outside_scopes(previous, scopes, keys, month, salts)
    result = kept.unionByName(inside_scopes(incoming, scopes, keys, month, salts))
    if unique and not repeated_keys(result, unique).isEmpty():
        raise ValueError(f"the replacement repeats keys of {', '.join(unique)}")
    return result
