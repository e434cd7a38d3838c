"""Quality scores: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

Features are words, pairs of words, word shapes (runs of letters, capitals, digits; other signs as they are) and
pairs of shapes with a mark for a repeated word, hashed into 2^bits slots. A document's value of a slot is its
count over the number of features, so the score is one sparse dot product, summed per document without loops.

Training takes at most `sample` labelled documents, drawn by id hash; scoring covers every whole text.

Defined results: a null or empty text has no features and scores by the bias alone; unlabelled, null-labelled and
null-id rows are never learned from; without any labels the score is 0.5; label rows that repeat count once,
contradicting ones both count; repeated documents score alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import lower, mix, pieces, text_bytes, word_bounds, word_hashes

BITS = 18
#: Documents that training may see at most.
SAMPLE = 4000

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


def _pairs(left: np.ndarray, first: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbours within a text, and the text of each."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    same = owner[1:] == owner[:-1]
    return mix(left[:-1] * np.uint64(0x9E3779B97F4A7C15) + left[1:], salt)[same], owner[1:][same]


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of every feature occurrence."""
    starts, ends, first = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    words = word_hashes(lower(data), starts, ends)
    shaped = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shaped[1:] != shaped[:-1]
    keep[starts] = True
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    shapes = word_hashes(shaped[keep], at[starts], at[ends])
    repeated = np.zeros(len(words), np.uint64)
    repeated[1:] = words[1:] == words[:-1]
    parts = [(mix(words, 1), owner), _pairs(words, first, 2), (mix(shapes, 3), owner), _pairs(shapes + repeated, first, 4)]
    slots = np.concatenate([h >> np.uint64(64 - bits) for h, _ in parts]).astype(np.int64)
    return np.concatenate([o for _, o in parts]), slots


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 6, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias from (slots, values, label) rows, one example at a time."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = 0.0
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            slots, values, label = rows[k]
            zs, ns = z[slots], n[slots]
            w = np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))
            bias = -bias_z / ((beta + np.sqrt(bias_n)) / 0.2)
            g = 1 / (1 + np.exp(-np.clip(w @ values + bias, -35, 35))) - label
            gs = g * values
            z[slots] = zs + gs - (np.sqrt(ns + gs * gs) - np.sqrt(ns)) / alpha * w
            n[slots] = ns + gs * gs
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / 0.2 * bias
            bias_n += g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w, float(-bias_z / ((beta + np.sqrt(bias_n)) / 0.2))


#: Feature values are counts over the number of features, times this, so that gradients have a useful size.
SCALE = 8.0


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch["text"])
        slots, values = [], []
        for k in range(batch.num_rows):
            _, s = features(data[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]]))
            u, c = np.unique(s, return_counts=True)
            slots.append(u.astype(np.int32).tobytes())
            values.append((c * (SCALE / max(1, len(s)))).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.binary()), pa.array(values, pa.binary()), batch["label"]], ["slots", "values", "label"])


def fit(documents: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Trains on at most `sample` labelled documents for whose id `learn` (over doc_id) holds."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn).select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)  # bounded, so it may be broadcast
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").mapInArrow(_sparse, "slots binary, values binary, label int").collect()
    ready = sorted((r["slots"], r["values"], r["label"]) for r in rows)
    return train([(np.frombuffer(s, np.int32), np.frombuffer(v, np.float32).astype(float), y) for s, v, y in ready])


def scored(documents: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """Adds nothing but returns (doc_id, held_out, score, predicted) of rows with doc_id, held_out and text."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            sums, counts = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, j in pieces(offsets):
                owner, slots = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sums[i:j] = np.bincount(owner, weights[slots], j - i)
                counts[i:j] = np.bincount(owner, minlength=j - i)
            p = 1 / (1 + np.exp(-np.clip(sums * SCALE / np.maximum(counts, 1) + bias, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return documents.select("doc_id", "held_out", "text").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
