"""Shared folders, text buffers, hashes, bit sets and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; a longer single text is one step.
PIECE_BYTES = 1 << 20
#: Space and the control characters from tab to carriage return end a word.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; on a local master without one, a new folder that becomes the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % divisor


# Text as bytes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one byte array, and the n + 1 offsets of the texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts that hold about `limit` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = last


# Hashes of words and byte windows

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20260101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads 64-bit values; different salts give independent values."""
    x = x + np.uint64((salt * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sums and inverse powers: the hash of [a, b) is (sums[b] - sums[a]) * inverse[a]."""
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers[:-1], out=sums[1:])
    return sums, inverse


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of its first word (n + 1 entries)."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:]
    ends[cuts[cuts > 0]] = inside[cuts[cuts > 0] - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums, inverse = prefix_hashes(data)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


# Bit sets of fixed size


def bit_set(frame: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A set of keys as 2^bits bits, so its size does not grow with the rows; members are always found, others rarely."""
    slot = F.pmod(key, F.lit(1 << bits)).cast("long") + 1
    rows = (
        frame.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(1 << bits, bool)
    for row in rows:
        got = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        first = (row["bucket"] - 1) * 32768
        part = out[first : first + len(got)]
        part |= got[: len(part)].astype(bool)
    return np.packbits(out, bitorder="little")


def in_bit_set(packed: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    slot = (keys.astype(np.int64) & ((1 << bits) - 1)).astype(np.int64)
    return (packed[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


# Connected components


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the undirected (a, b) edges; a component is its smallest node.

    Alternates large-star and small-star steps, each of which is a grouped minimum and a join, until no
    edge changes. A node with very many neighbours is never gathered: minima combine before the shuffle.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        pairs = both(edges)
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = pairs.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def ensure_local_tmp() -> str:
    """A task's own folder for spilled queues; removed by the task that made it."""
    return tempfile.mkdtemp(prefix="queues-", dir=os.environ.get("TMPDIR"))


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that this package wrote."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
