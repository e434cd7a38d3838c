"""Approximate nearest neighbours by multiprobe p-stable hashing with exact reranking.

A table hashes a vector by HASHES functions floor(a . v / width + b); the width is WIDTH times the root mean
square norm of all vectors. For a query, each table's buckets are
visited in estimated success order: the query's distances to the bucket borders are sorted, and sets of border
crossings come in the order of their expected squared distance. Candidates of all tables are merged and ranked by
their distance in double precision. Queries go to the tasks in blocks of bounded size, each block against all
rows; a task keeps the best of each query, so no vector is moved.

Equal vectors are one candidate that stands for its smallest ids, and equal queries are one query. A query that
met fewer than it should is answered by comparing with every row.

Defined results: vectors that are null, zero, of another than the most frequent length, or hold null or
non-finite components take no part, nor do null ids; rows that repeat an id are one (its least vector as a
query, its nearest as a candidate); ties go to the smaller id; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import stored

HASHES, TABLES, PROBES, WIDTH = 5, 12, 220, 1.0
BLOCK_QUERIES = 1024


def functions(dimension: int, hashes: int = HASHES, tables: int = TABLES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions (tables, hashes, dimension), shifts in [0, 1) and odd multipliers that join hashes to a key."""
    r = np.random.default_rng(11)
    return r.normal(size=(tables, hashes, dimension)), r.random((tables, hashes)), r.integers(0, 1 << 62, (tables, hashes)) * 2 + 1


def probe_order(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of ranks of border distances (0 is the nearest border) in expected order; the empty set comes first."""
    m = hashes
    expected = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 2 * m + 1)]
    out: list[tuple[int, ...]] = [()]
    heap = [(expected[0], (0,))]
    while heap and len(out) < probes:
        score, ranks = heapq.heappop(heap)
        if not any(2 * m - 1 - k in ranks for k in ranks):  # both borders of one hash cannot be crossed
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - expected[last] + expected[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (score + expected[last + 1], (*ranks, last + 1)))
    return out


def row_keys(vectors: np.ndarray, f: tuple[np.ndarray, np.ndarray, np.ndarray], width: float) -> np.ndarray:
    """Bucket keys (tables, n)."""
    a, b, odd = f
    h = np.floor(np.einsum("nd,thd->tnh", vectors, a, optimize=True) / width + b[:, None]).astype(np.int64)
    return (h * odd[:, None]).sum(-1)


def query_keys(queries: np.ndarray, f: tuple[np.ndarray, np.ndarray, np.ndarray], width: float, probes: int) -> np.ndarray:
    """Keys of the probed buckets (tables, queries, probes) in the order of visiting."""
    a, b, odd = f
    place = np.einsum("nd,thd->tnh", queries, a, optimize=True) / width + b[:, None]
    h = np.floor(place)
    low = place - h
    distance = np.concatenate([low, 1 - low], -1)  # to the lower and to the upper border
    move = np.concatenate([-odd, odd], -1)
    ranked = np.argsort(distance, -1, kind="stable")
    moves = np.take_along_axis(np.broadcast_to(move[:, None], distance.shape), ranked, -1)
    base = (h.astype(np.int64) * odd[:, None]).sum(-1)
    return np.stack([base + moves[..., list(ranks)].sum(-1) for ranks in probe_order(a.shape[1], probes)], -1)


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:n]
    return ids[first], scores[first]


def _scan(rows: DataFrame, queries: np.ndarray, keep: int, dimension: int, width: float, exact: bool) -> DataFrame:
    """(query, vec_id, score): of every task and query, by its number, the `keep` nearest candidates."""
    f = functions(dimension)
    shared = rows.sparkSession.sparkContext.broadcast((queries, None if exact else query_keys(queries, f, width, PROBES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, probed = shared.value
        found = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["vec_id"].to_numpy()
            vectors = batch["vector"].flatten().to_numpy().reshape(len(ids), dimension).astype(np.float64)
            # Equal vectors of the batch count once in buckets and distances, with their smallest ids.
            order = np.lexsort((ids, *vectors.T[::-1]))
            ids, vectors = ids[order], vectors[order]
            new = np.ones(len(ids), bool)
            new[1:] = (vectors[1:] != vectors[:-1]).any(1)
            group = np.cumsum(new) - 1
            begin = np.flatnonzero(new)
            within = np.arange(len(ids)) - begin[group]
            ids, group = ids[within < keep], group[within < keep]
            begin, count = np.searchsorted(group, np.arange(len(begin))), np.bincount(group)
            vectors = vectors[new]
            if exact:
                chosen = np.ones((len(queries), len(vectors)), bool)
            else:
                chosen = np.zeros((len(queries), len(vectors)), bool)
                for table, keys in enumerate(row_keys(vectors, f, width)):
                    buckets, own = np.unique(keys, return_inverse=True)
                    at = np.minimum(np.searchsorted(buckets, probed[table]), len(buckets) - 1)
                    q, p = np.nonzero(buckets[at] == probed[table])
                    visited = np.zeros((len(queries), len(buckets)), bool)
                    visited[q, at[q, p]] = True
                    chosen |= visited[:, own]
            for k, query in enumerate(queries):
                at = np.flatnonzero(chosen[k])
                if not len(at):
                    continue
                away = vectors[at] - query
                scores = np.sqrt(np.einsum("nd,nd->n", away, away))
                if len(at) > keep:
                    # Ties at the bound stay, ids decide below.
                    bound = np.partition(scores, keep - 1)[keep - 1]
                    at, scores = at[scores <= bound], scores[scores <= bound]
                each = np.repeat(begin[at], count[at]) + np.arange(count[at].sum()) - np.repeat(np.cumsum(count[at]) - count[at], count[at])
                found[k] = _best(np.concatenate([found[k][0], ids[each]]), np.concatenate([found[k][1], np.repeat(scores, count[at])]), keep)
        sizes = [len(i) for i, _ in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(found)), sizes)), pa.array(np.concatenate([i for i, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
            ["query", "vec_id", "score"],
        )

    return rows.select("vec_id", "vector").mapInArrow(run, "query long, vec_id long, score double")


def usable(rows: DataFrame) -> tuple[DataFrame, int, float]:
    """The (vec_id, vector) rows that take part, their length, and the root of their mean squared norm."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)
    most = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = most["d"] if most else 0
    rows = rows.where(F.size("vector") == dimension)
    squared = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    mean = rows.agg(F.avg(squared)).first()[0]
    return rows, dimension, float(f"{np.sqrt(mean or 1.0):.6g}")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, vector) that `is_query` marks, against all rows."""
    spark = embeddings.sparkSession
    rows, dimension, norm = usable(embeddings)
    key = [F.xxhash64("vector").alias("k1"), F.hash("vector").alias("k2")]
    asked = stored(rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")).select(F.col("vec_id").alias("query_id"), "vector", *key), "queries")
    distinct = stored(asked.groupBy("k1", "k2").agg(F.min("query_id").alias("first"), F.min("vector").alias("vector")), "query-vectors")
    blocks = -(-distinct.count() // block_queries)
    total = rows.select("vec_id").distinct().count() if blocks else 0
    enough = min(k + 1, total)

    def answers(frame: DataFrame, exact: bool) -> DataFrame:
        got = frame.select("first", "vector").orderBy("first").collect()  # one block
        found = _scan(rows, np.array([r["vector"] for r in got], np.float64).reshape(len(got), dimension), k + 1, dimension, WIDTH * norm, exact)
        names = spark.createDataFrame([(n, r["first"]) for n, r in enumerate(got)], "query long, first long")
        found = found.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
        return found.withColumn("r", rank).where(F.col("r") <= k + 1).join(F.broadcast(names), "query").select("first", "vec_id", "score")

    out = spark.createDataFrame([], "first long, vec_id long, score double")
    for b in range(blocks):
        block = distinct.where(F.pmod(F.xxhash64("first"), F.lit(blocks)) == b)
        found = stored(answers(block, False), "found")
        out = out.union(found)
        short = block.join(found.groupBy("first").count().where(F.col("count") >= enough), "first", "left_anti")
        if not short.isEmpty():
            met = short.select("first")
            out = out.join(met, "first", "left_anti").union(stored(answers(short, True), "found"))
    named = asked.select("query_id", "k1", "k2").join(distinct.select("k1", "k2", "first"), ["k1", "k2"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    pairs = named.join(out, "first").where("vec_id <> query_id").withColumn("rank", rank).where(F.col("rank") <= k)
    return pairs.select("query_id", "rank", "vec_id", "score")
