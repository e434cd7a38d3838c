"""Language of whole texts: a bidirectional gated recurrent network over bytes.

Texts are cut into windows of WINDOW bytes that are sequences of their own, so no text is too long. The network
labels every position with a distribution over the learned languages; a document's probabilities are their mean
over its positions. Training is backpropagation through time in numpy on at most `per_language` documents of each
language and `per_document` windows of each; prediction covers every byte of every text.

Defined results: a null text, or one without a letter, is `und` with score 0; nothing learned (no labelled text)
makes every text `und`; documents with null or withheld ids, null lang or without letters are never learned from;
repeated documents are judged alike; further columns are ignored by `predicted` and kept by `recognised`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import lower, stored, text_bytes

WINDOW, HIDDEN = 64, 6
PER_LANGUAGE, PER_DOCUMENT = 400, 4
#: Windows that go through the network together.
BATCH = 2048
_LETTER = "\\p{L}"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


def _run(x: np.ndarray, p: dict[str, np.ndarray], way: str) -> tuple[np.ndarray, list]:
    """Hidden states (steps, rows, hidden) of one direction over bytes x (steps, rows), and what training needs."""
    table, u, un = p["table" + way], p["u" + way], p["un" + way]
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    out = np.empty((len(x), x.shape[1], HIDDEN), np.float32)
    saved = []
    for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
        a = table[x[t]]
        rz = _sigmoid(a[:, : 2 * HIDDEN] + h @ u)
        r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
        rh = r * h
        n = np.tanh(a[:, 2 * HIDDEN :] + rh @ un)
        saved.append((t, h, r, z, n, rh))
        out[t] = h = n + z * (h - n)
    return out, saved


def _states(x: np.ndarray, p: dict[str, np.ndarray], way: str) -> np.ndarray:
    """The same states as (steps, hidden, rows), with gates in place: several times as fast, nothing kept."""
    scale = np.repeat(np.float32([0.5, 1]), [2 * HIDDEN, HIDDEN])
    table = np.ascontiguousarray((p["table" + way] * scale).T)
    u, un = np.ascontiguousarray(p["u" + way].T) * np.float32(0.5), np.ascontiguousarray(p["un" + way].T)
    rows = x.shape[1]
    h, q, n = (np.zeros((HIDDEN, rows), np.float32) for _ in range(3))
    a, rz = np.empty((3 * HIDDEN, rows), np.float32), np.empty((2 * HIDDEN, rows), np.float32)
    out = np.empty((len(x), HIDDEN, rows), np.float32)
    for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
        np.take(table, x[t], axis=1, out=a, mode="clip")
        np.matmul(u, h, out=rz)
        rz += a[: 2 * HIDDEN]
        np.tanh(rz, out=rz)  # 2 * sigmoid - 1
        rz += 1
        rz *= np.float32(0.5)
        np.multiply(rz[:HIDDEN], h, out=q)
        np.matmul(un, q, out=n)
        n += a[2 * HIDDEN :]
        np.tanh(n, out=n)
        np.subtract(h, n, out=q)
        q *= rz[HIDDEN:]
        np.add(n, q, out=out[t])
        h = out[t]
    return out


def _softmax(logits: np.ndarray, axis: int = -1) -> np.ndarray:
    logits = np.exp(logits - logits.max(axis, keepdims=True))
    return logits / logits.sum(axis, keepdims=True)


def position_labels(x: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """Distribution over the languages at every position of windows x (steps, rows): (steps, languages, rows)."""
    logits = np.ascontiguousarray(p["of"].T) @ _states(x, p, "f")
    logits += np.ascontiguousarray(p["ob"].T) @ _states(x, p, "b")
    logits += p["bias"][:, None]
    np.clip(logits, -40, 40, out=logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def _gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, p: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], float]:
    states = {way: _run(x, p, way) for way in "fb"}
    prob = _softmax(states["f"][0] @ p["of"] + states["b"][0] @ p["ob"] + p["bias"])
    rows = np.arange(x.shape[1])
    total = max(1.0, float(mask.sum()))
    loss = -float((np.log(prob[:, rows, y] + 1e-9) * mask).sum()) / total
    d = prob.copy()
    d[:, rows, y] -= 1
    d *= (mask / total)[:, :, None]
    g = {"bias": d.sum((0, 1))}
    for way in "fb":
        out, saved = states[way]
        g["o" + way] = np.einsum("trh,trk->hk", out, d, optimize=True)
        dout = d @ p["o" + way].T
        gu, gn = np.zeros_like(p["u" + way]), np.zeros_like(p["un" + way])
        inner = np.empty((*x.shape, 3 * HIDDEN), np.float32)
        carry = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t, h, r, z, n, rh in reversed(saved):
            dh = dout[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            drh = dn @ p["un" + way].T
            dr = drh * h * r * (1 - r)
            drz = np.concatenate([dr, dz], 1)
            carry = dh * z + drh * r + drz @ p["u" + way].T
            gn += rh.T @ dn
            gu += h.T @ drz
            inner[t, :, : 2 * HIDDEN], inner[t, :, 2 * HIDDEN :] = drz, dn
        order = np.argsort(x, axis=None, kind="stable")
        bytes_seen, first = np.unique(x.ravel()[order], return_index=True)
        gt = np.zeros_like(p["table" + way])
        gt[bytes_seen] = np.add.reduceat(inner.reshape(-1, 3 * HIDDEN)[order], first)
        g["table" + way], g["u" + way], g["un" + way] = gt, gu, gn
    return g, loss


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: int, epochs: int = 8, rows: int = 128, rate: float = 0.02, least_steps: int = 200) -> dict[str, np.ndarray]:
    """Weights from windows (n, WINDOW) of bytes, by Adam over backpropagation through time; few windows are seen oftener."""
    epochs = max(epochs, -(-least_steps // -(-len(windows) // rows)))
    r = np.random.default_rng(7)
    size = {"of": (HIDDEN, languages), "ob": (HIDDEN, languages), "bias": (languages,)}
    for way in "fb":
        size |= {"table" + way: (256, 3 * HIDDEN), "u" + way: (HIDDEN, 2 * HIDDEN), "un" + way: (HIDDEN, HIDDEN)}
    p = {k: (r.normal(size=s) * (0.3 if len(s) > 1 else 0)).astype(np.float32) for k, s in size.items()}
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    step = 0
    steps = epochs * -(-len(windows) // rows)
    for _ in range(epochs):
        order = r.permutation(len(windows))
        for first in range(0, len(order), rows):
            k = order[first : first + rows]
            x = np.ascontiguousarray(windows[k].T)
            mask = (np.arange(WINDOW)[:, None] < lengths[k][None]).astype(np.float32)
            g, _ = _gradients(x, mask, labels[k], p)
            step += 1
            now = rate * max(0.05, 1 - step / (steps + 1))
            for name, grad in g.items():
                grad = np.clip(grad, -1, 1)
                m[name] += 0.1 * (grad - m[name])
                v[name] += 0.01 * (grad * grad - v[name])
                p[name] -= (now * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PER_DOCUMENT windows of each text, spread evenly with a shift that the id fixes."""
    for batch in batches:
        data, offsets = text_bytes(batch["text"])
        data = lower(data)
        out: tuple[list, list] = ([], [])
        for k, lang in enumerate(batch["lang"].to_pylist()):
            text = data[offsets[k] : offsets[k + 1]]
            cuts = max(1, -(-len(text) // WINDOW))
            r = np.random.default_rng(batch["doc_id"][k].as_py() & 0x7FFFFFFF)
            for c in np.sort(r.permutation(cuts)[:PER_DOCUMENT]):
                out[0].append(text[c * WINDOW : (c + 1) * WINDOW].tobytes())
                out[1].append(lang)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.string())], ["window", "lang"])


Model = tuple[list[str], dict[str, np.ndarray]]


def fit(documents: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Learned languages and weights from documents for whose doc_id `learn` holds."""
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & learn & F.col("text").rlike(_LETTER))
    ids = stored(known.select("doc_id", "lang").distinct().withColumn("hash", F.xxhash64("doc_id")), "labelled")
    # The smallest hashes of a language are about evenly spread, so those under four times the share that is wanted hold
    # all of them; only these are ranked, however many documents the language has. One row a language is broadcast.
    share = F.least(F.lit(1.0), 4.0 * per_language / F.col("count"))
    low = ids.join(F.broadcast(ids.groupBy("lang").count()), "lang").where(F.col("hash") / F.lit(2.0**64) + 0.5 <= share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    chosen = low.select("doc_id", "lang", "hash").withColumn("rank", rank).where(F.col("rank") <= per_language).select("doc_id", "lang")
    rows = sorted(
        (r["lang"], r["window"])
        for r in documents.select("doc_id", "lang", "text").where(F.col("text").rlike(_LETTER)).join(F.broadcast(chosen), ["doc_id", "lang"])
        .select("doc_id", "lang", "text").mapInArrow(_draw, "window binary, lang string").collect()
    )
    languages = sorted({r[0] for r in rows})
    if not rows:
        return [], {}
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    for k, (_, w) in enumerate(rows):
        windows[k, : len(w)] = np.frombuffer(w, np.uint8)
    lengths = np.array([len(w) for _, w in rows])
    labels = np.array([languages.index(lang) for lang, _ in rows])
    return languages, train(windows, lengths, labels, len(languages))


def document_probabilities(data: np.ndarray, offsets: np.ndarray, p: dict[str, np.ndarray], languages: int) -> np.ndarray:
    """Mean of the position labels of every text (n, languages); zeros for an empty one."""
    lengths = np.diff(offsets)
    cuts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), cuts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    starts = offsets[:-1][owner] + within * WINDOW
    held = np.minimum(WINDOW, offsets[1:][owner] - starts)
    sums = np.zeros((len(lengths), languages))
    padded = np.concatenate([lower(data), np.zeros(WINDOW, np.uint8)])
    for first in range(0, len(owner), BATCH):
        at, n, who = starts[first : first + BATCH], held[first : first + BATCH], owner[first : first + BATCH]
        mask = np.arange(WINDOW)[:, None] < n[None]
        x = padded[at[None] + np.arange(WINDOW)[:, None]] * mask.astype(np.uint8)
        labels = position_labels(x, p)
        pooled = np.einsum("tkr,tr->kr", labels, mask.astype(np.float32))
        for k in range(languages):
            sums[:, k] += np.bincount(who, pooled[k], len(lengths))
    return sums / np.maximum(lengths, 1)[:, None]


def _judge(batch: pa.RecordBatch, model: Model) -> tuple[list[str], np.ndarray]:
    languages, weights = model
    n = batch.num_rows
    letters = np.array(batch["has_letter"].to_pylist(), bool)
    if not languages:
        return ["und"] * n, np.zeros(n)
    data, offsets = text_bytes(batch["text"])
    prob = document_probabilities(data, offsets, weights, len(languages))
    best = prob.argmax(1)
    score = np.where(letters, np.minimum(prob[np.arange(n), best], 1.0), 0.0)
    return [languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], score


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(_LETTER), F.lit(False))


def _shared(documents: DataFrame, model: Model) -> Broadcast:
    return documents.sparkSession.sparkContext.broadcast(model)


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of rows with doc_id, held_out and text."""
    shared = _shared(documents, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = _judge(batch, shared.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select("doc_id", "held_out", "text", _has_letter().alias("has_letter"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def recognised(documents: DataFrame, model: Model, least_score: float) -> DataFrame:
    """The documents, unchanged, whose text has a language with at least `least_score`."""
    shared = _shared(documents, model)
    columns = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = _judge(batch, shared.value)
            keep = pa.array([x != "und" and s >= least_score for x, s in zip(lang, score, strict=True)], pa.bool_())
            yield batch.select(columns).filter(keep)

    return documents.withColumn("has_letter", _has_letter()).mapInArrow(run, documents.schema)
