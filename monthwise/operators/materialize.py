"""Compute something once that several expressions or branches use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.session import checkpoint_folder


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the session's shared checkpoint folder.

    Runs a job.  Later branches scan the table with column pruning and pushed filters,
    and survive lost executors without going back to the raw sources.
    """
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def computed_once(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The frame with costly columns added, each evaluated once per row.

    Plain columns are substituted into every later filter and projection, which repeats
    an expensive expression for each use.  Columns that leave a generator are not.
    """
    made = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    return frame.select("*", F.inline(made))
