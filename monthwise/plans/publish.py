"""Verified writes, month-partitioned replacement and pinned generations.

Tables are directories of Parquet on storage that every executor sees.  Generation
manifests are tables too: readers pick a generation number and get exactly its tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthwise import contracts
from monthwise.functions.signatures import content_measures, fingerprint
from monthwise.operators.quality import repeated_keys
from monthwise.operators.scope import Scope, in_scope, replace_rows, touched_months
from monthwise.operators.scope_tables import covered_months, replace_rows_by_table

MANIFEST = (
    "generation bigint, table_name string, row_count bigint, content_hash string, "
    "build_kind string, run_id string"
)


class PublicationError(RuntimeError):
    """A written table differs from what was meant to be written."""


def write_verified(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> dict:
    """Writes Parquet (zstd) to a new path, reads it back and compares schema and content.

    The rows are measured while they are written, so the frame is evaluated once; only the
    check reads the stored table again.  Returns the measures of what is stored.
    """
    seen = Observation()
    writer = (
        frame.observe(seen, *content_measures(frame.columns))
        .write.mode("errorifexists")
        .option("compression", "zstd")
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    expected = seen.get
    spark = frame.sparkSession
    # A table without rows may have no file to read a schema from.
    stored_schema = spark.read.parquet(path).schema if expected["row_count"] else frame.schema
    names = {f.name: f.dataType for f in stored_schema.fields}
    for field in frame.schema.fields:
        if field.name not in partition_by and names.get(field.name) != field.dataType:
            raise PublicationError(f"{path}: column {field.name} was not stored as declared")
    written = spark.read.schema(frame.schema).parquet(path).select(frame.columns)
    actual = written.agg(*content_measures(frame.columns)).first().asDict()
    if expected != actual:
        raise PublicationError(f"{path}: wrote {actual}, expected {expected}")
    return actual


def write_slice_audit(audit: DataFrame, path: str) -> None:
    """Appends per-slice capture statistics to the audit table."""
    audit.write.mode("append").option("compression", "zstd").parquet(path)


def write_forecast_run(frame: DataFrame, path: str) -> None:
    """Predictions or metrics of a run under run_id=<id>; rerunning a run replaces it."""
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("run_id")
        .parquet(path)
    )


def write_month_table(frame: DataFrame, path: str, month: str = "period_month") -> None:
    """First write of a table that replacements will change month by month.

    Rows are clustered by month before the write, split further where a month is large
    (AQE rebalance), so a month is a few files and a hot month is not one task.
    """
    (
        frame.hint("rebalance", month)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy(month)
        .parquet(path)
    )


def replace_in_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    scopes: Iterable[Scope],
    table: str,
    month: str = "period_month",
    key: Sequence[str] = (),
) -> list[date]:
    """Replaces the scopes of a month-partitioned table in place; returns emptied months.

    Only months inside a scope are read and rewritten.  The new months are written beside the table, on
    its own file system, and compared with what was meant to be written; a failed build, a staged copy that
    differs or cannot be read, or a repeated ``key`` raises and leaves the table as it was.  Then they
    overwrite their partitions.  A month that the new version withdrew completely has no
    partition in the staged data and is therefore emptied explicitly.
    """
    scopes = list(scopes)
    months = touched_months(scopes)
    columns = contracts.schema(table).fieldNames()
    current = spark.read.schema(contracts.schema(table)).parquet(path).select(columns)
    touched = current.where(F.col(month).isin(*months))
    result = replace_rows(touched, incoming.select(columns), scopes, month)
    return _exchange_months(spark, path, result, months, table, month, key)


def replace_in_table_by(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    scopes: DataFrame,
    keys: Sequence[str],
    table: str,
    month: str = "period_month",
    key: Sequence[str] = (),
) -> list[date]:
    """As :func:`replace_in_table`, with a scope table; only the months, one for each of the calendar, are collected."""
    columns = contracts.schema(table).fieldNames()
    months = [row[0] for row in covered_months(scopes, month=month).distinct().orderBy(month).collect()]
    current = spark.read.schema(contracts.schema(table)).parquet(path).select(columns)
    touched = current.where(F.col(month).isin(*months))
    result = replace_rows_by_table(touched, incoming.select(columns), scopes, keys, month)
    return _exchange_months(spark, path, result, months, table, month, key)


def _exchange_months(
    spark: SparkSession, path: str, result: DataFrame, months: list[date], table: str, month: str, key: Sequence[str]
) -> list[date]:
    columns = contracts.schema(table).fieldNames()
    staged_path = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    measures = write_verified(result.hint("rebalance", month), staged_path, (month,))
    staged = spark.read.schema(contracts.schema(table)).parquet(staged_path).select(columns)
    if key and not repeated_keys(staged, key).isEmpty():
        raise PublicationError(f"{path}: the replacement repeats keys of {', '.join(key)}")
    counts = {row[0]: row[1] for row in staged.groupBy(month).count().collect()}
    if sum(counts.values()) != measures["row_count"]:
        raise PublicationError(f"{path}: staged months hold {sum(counts.values())} of {measures['row_count']} rows")
    left = set(counts)
    if left:
        (
            staged.hint("rebalance", month)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(month)
            .parquet(path)
        )
    emptied = [m for m in months if m not in left]
    no_rows = spark.createDataFrame([], contracts.schema(table)).drop(month)
    for gone in emptied:
        no_rows.write.mode("overwrite").parquet(f"{path}/{month}={gone.isoformat()}")
    return emptied


def untouched_differences(
    before: DataFrame, after: DataFrame, scopes: Iterable[Scope], month: str = "period_month"
) -> DataFrame:
    """Fingerprints of both versions outside the scopes; two equal rows mean unchanged."""
    scopes = list(scopes)
    return fingerprint(before.where(~in_scope(scopes, month)), "before").unionByName(
        fingerprint(after.where(~in_scope(scopes, month)), "after")
    )


def publish_generation(
    root: str, tables: Mapping[str, DataFrame], build_kind: str, run_id: str
) -> int:
    """Writes every table under generation=<n> and then its manifest; returns n.

    The manifest is written last: a generation without one was not completed and readers
    never see it.
    """
    if not build_kind or not run_id:
        raise ValueError("a generation needs a build kind and a run id")
    spark = next(iter(tables.values())).sparkSession
    number = latest_generation(spark, root) + 1
    rows = []
    for name, frame in tables.items():
        target = f"{root}/tables/generation={number}/run={run_id}/{name}"
        stored = write_verified(frame, target)
        rows.append((number, name, stored["row_count"], stored["content_hash"], build_kind, run_id))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(
        f"{root}/manifest"
    )
    return number


def generations(spark: SparkSession, root: str) -> DataFrame:
    """Manifest rows of all completed generations."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # only an absent manifest means that nothing was published
            raise
        return spark.createDataFrame([], MANIFEST)


def latest_generation(spark: SparkSession, root: str) -> int:
    """Number of the newest completed generation, 0 when there is none."""
    return generations(spark, root).agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]


def read_generation(
    spark: SparkSession, root: str, number: int | None = None
) -> dict[str, DataFrame]:
    """Tables of one pinned generation; the newest when no number is given."""
    number = number or latest_generation(spark, root)
    entries = generations(spark, root).where(F.col("generation") == number).collect()
    if not entries:
        raise PublicationError(f"generation {number} does not exist")
    return {
        e.table_name: spark.read.parquet(
            f"{root}/tables/generation={number}/run={e.run_id}/{e.table_name}"
        )
        for e in entries
    }
