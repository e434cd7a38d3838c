"""Physical schema of Parquet files, read from their footers as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise import contracts

_FOOTER = "path string, row_count long, columns array<struct<name:string,type:string>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    def spark_type(kind: pa.DataType) -> str:
        try:
            return from_arrow_type(kind).simpleString()
        except Exception:  # a type that Spark has no counterpart for is reported under its own name
            return str(kind)

    out = pa.schema([
        ("path", pa.string()), ("row_count", pa.int64()),
        ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))),
    ])
    for batch in batches:
        rows = []
        for path in batch["path"].to_pylist():
            store, name = pyarrow.fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as source:
                found = pq.ParquetFile(source)
                columns = [{"name": f.name, "type": spark_type(f.type)} for f in found.schema_arrow]
                rows.append({"path": path, "row_count": found.metadata.num_rows, "columns": columns})
        yield pa.RecordBatch.from_pylist(rows, schema=out)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(path, row_count, columns) of every Parquet file under a path; only footers are read, by the executors.

    Columns that the folders name (``name=value``) belong to the files below them; they have the type ``folder``.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    ).select("path")
    read = listed.mapInArrow(_read, _FOOTER)
    root = re.sub("^[A-Za-z0-9]+:/+", "/", path).rstrip("/")
    below = F.expr("substring(path, instr(path, root) + char_length(root))")
    folders = F.transform(
        F.regexp_extract_all(below, F.lit("/([A-Za-z_][A-Za-z0-9_]*)=[^/]*"), F.lit(1)),
        lambda name: F.struct(name.alias("name"), F.lit("folder").alias("type")),
    )
    return read.withColumn("root", F.lit(root)).withColumn("columns", F.concat("columns", folders)).drop("root")


def file_drift(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Columns that files lack, hold beyond the contract, or hold in another type, with the files and rows concerned.

    Reading with the declared schema would turn the first into nulls and hide the second.  Empty means that every
    file is as declared.
    """
    contract = F.array(*[
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in contracts.schema(table).fields
    ])
    both = footers(spark, path).withColumn("declared", contract)
    named = lambda array, name: F.get(F.filter(array, lambda c: c["name"] == name), F.lit(0))["type"]

    def problem(kind: str, name, declared, found):
        return F.struct(F.lit(kind).alias("problem"), name.alias("column_name"), declared.alias("declared_type"), found.alias("found_type"))

    no_type = F.lit(None).cast("string")
    absent = F.transform(
        F.filter("declared", lambda d: named("columns", d["name"]).isNull()),
        lambda d: problem("absent", d["name"], d["type"], no_type),
    )
    undocumented = F.transform(
        F.filter("columns", lambda c: named("declared", c["name"]).isNull()),
        lambda c: problem("undocumented", c["name"], no_type, c["type"]),
    )
    retyped = F.transform(
        F.filter("columns", lambda c: (c["type"] != "folder") & (named("declared", c["name"]) != c["type"])),
        lambda c: problem("wrong_type", c["name"], named("declared", c["name"]), c["type"]),
    )
    return (
        both.select("path", "row_count", F.inline(F.concat(absent, undocumented, retyped)))
        .groupBy(F.lit(table).alias("table_name"), "problem", "column_name", "declared_type", "found_type")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("affected_rows"), F.min("path").alias("example_path"))
    )
