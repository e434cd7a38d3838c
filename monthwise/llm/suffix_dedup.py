"""Exact substring deduplication: bytes of strings of LENGTH bytes that also start earlier are removed.

Every LENGTH-byte string has one anchor, its leftmost least hash of GRAM bytes, so equal strings have equal anchors
at equal places. The strings of one anchor occurrence form one stretch of text, its context. Anchors that occur
once in the corpus cannot matter and stay behind; the contexts of the others are dealt by anchor. A context
that occurred before, whole, is wholly repeated. The different contexts are collected into shards of about
SHARD_BYTES, whose suffixes are put in order by external induced sorting with common prefixes (induced_sort); runs
that share LENGTH bytes are the repeated strings, and all but the earliest start of a run are removed.

Whole copies of a text are found by digest before that, so they never meet in a shard.

Defined results: null texts are empty; a text under LENGTH bytes loses nothing; equal doc_ids are not before one
another, whatever their texts, and the null id comes last; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import bit_set, in_bit_set, mix, pieces, prefix_hashes, stored, text_bytes
from monthwise.llm.induced_sort import suffix_order

LENGTH, GRAM = 100, 32
SHARD_BYTES = 4 << 20
#: Anchors that occur twice are held as 2^REPEATED_BITS bits; a wrong bit costs a comparison.
REPEATED_BITS = 26
#: Bytes of a text that are scanned at once; longer texts are scanned in overlapping parts.
_PART = 1 << 22
_PLACE_BITS = 26
_KEY = np.uint64((1 << 40) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, first string start, last string start, anchor place, anchor hash) of every anchor occurrence."""
    span = LENGTH - GRAM + 1
    n = len(data) - GRAM + 1
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    sums, inverse = prefix_hashes(data)
    grams = mix((sums[GRAM:] - sums[:n]) * inverse[:n])
    key = (grams >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | np.arange(n, dtype=np.uint64)
    rows = -(-n // span)
    grid = np.full(rows * span, np.uint64((1 << 64) - 1))
    grid[:n] = key
    grid = grid.reshape(rows, span)
    ahead = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, 1).ravel()
    starts = n - span + 1  # strings of the whole buffer
    place = (np.minimum(ahead[:starts], behind[span - 1 : span - 1 + starts]) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    lengths = np.diff(offsets)
    own = np.flatnonzero(lengths >= LENGTH)
    valid = np.zeros(starts + 1, np.int64)
    np.add.at(valid, offsets[own], 1)
    np.add.at(valid, np.minimum(offsets[own + 1] - LENGTH + 1, starts), -1)
    inside = np.cumsum(valid[:-1]) > 0
    at = np.flatnonzero(inside)
    if not len(at):
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (place[at[1:]] != place[at[:-1]])
    new[np.searchsorted(at, offsets[own])] = True
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    return np.searchsorted(offsets, first, "right") - 1, first, last, place[first], grams[place[first]]


def _parts(column: pa.Array, skip: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, place of the first byte in it, bytes, offsets) of texts that are not skipped."""
    data, offsets = text_bytes(column)
    lengths = np.where(skip, 0, np.diff(offsets))
    for i, j in pieces(offsets):
        if j - i == 1 and lengths[i] > _PART:
            for c in range(0, int(lengths[i]), _PART):
                part = data[offsets[i] + c : min(offsets[i] + c + _PART + LENGTH - 1, offsets[j])]
                yield i, c, part, np.array([0, len(part)])
        elif not skip[i:j].any():
            yield i, 0, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        else:
            own = np.concatenate([data[offsets[k] : offsets[k] + lengths[k]] for k in range(i, j)])
            yield i, 0, own, np.concatenate([[0], np.cumsum(lengths[i:j])])


class _Copies:
    """Tells which rows repeat a text of the task that has a smaller id."""

    def __init__(self) -> None:
        self.seen: dict[tuple[int, int], int] = {}

    def skip(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(batch.num_rows, bool)
        for k, (h1, h2, doc_id) in enumerate(zip(*(batch[c].to_pylist() for c in ("h1", "h2", "order_id")), strict=True)):
            before = self.seen.get((h1, h2))
            if before is not None and before < doc_id:
                out[k] = True
            else:
                self.seen[h1, h2] = doc_id
        return out


_SCAN = ["h1", "h2", "order_id", "text"]
_CONTEXT = "anchor long, context long, order_id long, h1 long, start long, lead int, bytes binary"


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    copies = _Copies()
    for batch in batches:
        for _, _, data, offsets in _parts(batch["text"], copies.skip(batch)):
            *_, hashes = anchors(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array((hashes & _KEY).astype(np.int64))], ["anchor"])


def contexts(rows: DataFrame) -> DataFrame:
    """The contexts of all anchors that may occur more than once."""
    spark = rows.sparkSession
    counted = rows.select(*_SCAN).mapInArrow(_anchor_hashes, "anchor long").groupBy("anchor").count()
    repeated = spark.sparkContext.broadcast(bit_set(counted.where("count > 1"), F.col("anchor"), REPEATED_BITS))
    names = [x.split()[0] for x in _CONTEXT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies = _Copies()
        for batch in batches:
            ids, h1 = batch["order_id"].to_numpy(), batch["h1"].to_numpy()
            for text, base, data, offsets in _parts(batch["text"], copies.skip(batch)):
                owner, first, last, place, hashes = anchors(data, offsets)
                use = in_bit_set(repeated.value, hashes & _KEY, REPEATED_BITS)
                owner, first, last, place, hashes = (x[use] for x in (owner, first, last, place, hashes))
                sums, inverse = prefix_hashes(data)
                end = last + LENGTH
                whole = mix(mix((sums[end] - sums[first]) * inverse[first]) + ((end - first) << 16 | (place - first)).astype(np.uint64))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.astype(np.int64)), pa.array(whole.astype(np.int64)), pa.array(ids[text + owner]), pa.array(h1[text + owner]),
                     pa.array(first - offsets[owner] + base), pa.array((place - first).astype(np.int32)),
                     pa.array([raw[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)], pa.binary())],
                    names,
                )

    return rows.select(*_SCAN).mapInArrow(run, _CONTEXT)


_SPAN = "order_id long, h1 long, first long, last long"


def _spans(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in _SPAN.split(", ")])


def repeated_in_shard(texts: list[bytes], ids: np.ndarray, h1: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context number, first, last) of the stretches covered by LENGTH-byte strings that start earlier in the shard."""
    lengths = np.array([len(t) for t in texts])
    text = np.frombuffer(b"\0".join(texts), np.uint8)
    base = np.cumsum(lengths + 1) - lengths - 1
    order, lcp = suffix_order(text, LENGTH)
    shared = lcp >= LENGTH
    run = np.cumsum(~shared)
    shared[:-1] |= shared[1:]
    order, run = order[shared].astype(np.int64), run[shared]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + 1)[order]
    place = order - base[owner]
    whole = place + LENGTH <= lengths[owner]  # others are no strings of their context
    order, run, owner, place = order[whole], run[whole], owner[whole], place[whole]
    if not len(order):
        return (np.zeros(0, np.int64),) * 3
    begin = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(run))))
    later = ids[owner] > np.minimum.reduceat(ids[owner], begin)[run]
    # Places are compared within one text only: other texts of the least id each keep their own earliest place.
    tied = np.flatnonzero(~later & (np.add.reduceat(~later, begin, dtype=np.int64) > 1)[run])
    at, text_of = starts[owner[tied]] + place[tied], h1[owner[tied]]
    by = np.lexsort((at, text_of, run[tied]))
    tied, at, text_of = tied[by], at[by], text_of[by]
    new = np.ones(len(tied), bool)
    new[1:] = (run[tied[1:]] != run[tied[:-1]]) | (text_of[1:] != text_of[:-1])
    later[tied] = at > at[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
    # In order of the text, strings that overlap or touch are one stretch.
    gone = np.zeros(len(text), bool)
    gone[order[later]] = True
    gone = np.flatnonzero(gone)
    owner = np.searchsorted(base, gone, "right") - 1
    new = np.ones(len(gone), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (np.diff(gone) > LENGTH)
    first, last = gone[new], gone[np.append(new[1:], True)[: len(gone)]] + LENGTH
    return owner[new], first - base[owner[new]], last - base[owner[new]]


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of contexts sorted by anchor, context, order_id, h1, start: the spans to remove."""
    names = ("anchor", "context", "order_id", "h1", "start")
    shard: list[tuple] = []  # (order_id, h1, start, bytes) arrays: first occurrences of contexts of anchors with several
    open_group: list[tuple] = []  # the same with their anchor, which the next batch may go on with
    size = 0
    before = None  # (anchor, context, h1) of the last row
    least = start_before = 0  # the least id of its context and the start of its original

    def flush() -> pa.RecordBatch:
        ids, h1, starts = (np.concatenate([x[k] for x in shard]) for k in range(3))
        k, first, last = repeated_in_shard([t for x in shard for t in x[3]], ids, h1, starts)
        return _spans(ids[k], h1[k], starts[k] + first, starts[k] + last)

    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, context, order_id, h1, start = (batch[c].to_numpy() for c in names)
        rows = np.arange(len(anchor))
        same = np.zeros(len(anchor), bool)  # in the context of the row before
        same[1:] = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
        same[0] = before is not None and before[:2] == (anchor[0], context[0])
        head = np.maximum.accumulate(np.where(same, -1, rows))
        ids = np.where(head < 0, least, order_id[head])
        # The first row of a context, and of each other text under the same least id, which is not after it.
        other = np.zeros(len(anchor), bool)
        other[1:] = h1[1:] != h1[:-1]
        other[0] = before is not None and before[2] != h1[0]
        original = ~same | (other & (order_id == ids))
        at = np.maximum.accumulate(np.where(original, rows, -1))
        starts = np.where(at < 0, start_before, start[at])
        found = ~original & ((order_id > ids) | (start > starts))
        lengths = pc.binary_length(batch["bytes"]).to_numpy()
        yield _spans(order_id[found], h1[found], start[found], (start + lengths)[found])
        goes_on = before is not None and before[0] == anchor[-1]  # a batch of one anchor, that of the batch before
        before, least, start_before = (anchor[-1], context[-1], h1[-1]), ids[-1], starts[-1]

        texts = np.array(batch["bytes"].filter(pa.array(original)).to_pylist(), object)
        open_group.append((order_id[original], h1[original], start[original], texts, anchor[original]))
        if goes_on:
            continue
        group = tuple(np.concatenate([x[k] for x in open_group]) for k in range(5))
        done = group[4] != anchor[-1]
        open_group = [tuple(c[~done] for c in group)]
        shard.append(_of_several(tuple(c[done] for c in group)))
        size += sum(map(len, shard[-1][3]))
        if size > SHARD_BYTES:
            yield flush()
            shard, size = [], 0
    if open_group:
        shard.append(_of_several(tuple(np.concatenate([x[k] for x in open_group]) for k in range(5))))
    if sum(len(x[3]) for x in shard):
        yield flush()


def _of_several(group: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """(order_id, h1, start, bytes) of the contexts whose anchor has another; anchors come last and sorted."""
    anchor = group[4]
    next_to = np.zeros(len(anchor), bool)
    next_to[1:] = anchor[1:] == anchor[:-1]
    next_to[:-1] |= next_to[1:]
    return tuple(c[next_to] for c in group[:4])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch["text"])
        n, rows = batch.num_rows, np.arange(batch.num_rows)
        whole = batch["whole"].to_numpy(zero_copy_only=False)
        spans, owner = batch["spans"].flatten(), pc.list_parent_indices(batch["spans"]).to_numpy()
        first, last = (spans.field(k).to_numpy() for k in ("first", "last"))
        use = (last > first) & ~whole[owner]
        # One place is left between texts, so that only stretches of one text merge.
        base = offsets[owner[use]] + owner[use]
        order = np.argsort(base + first[use])
        first, last = (base + first[use])[order], np.maximum.accumulate((base + last[use])[order])
        new = np.ones(len(first), bool)
        new[1:] = first[1:] > last[:-1]
        first, last = first[new], last[np.append(new[1:], True)[: len(new)]]
        cuts = np.searchsorted(first, offsets + np.append(rows, n))
        lengths = np.diff(offsets)
        n_removed = np.where(whole, lengths, np.diff(np.append(0, np.cumsum(last - first))[cuts]))
        n_spans = np.where(whole, lengths > 0, np.diff(cuts))
        digests = []
        for k, begin, end in zip(rows.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            digest = hashlib.sha256()
            if not whole[k]:
                for i in range(cuts[k], cuts[k + 1]):
                    digest.update(data[begin : first[i] - k])
                    begin = last[i] - k
                digest.update(data[begin:end])
            digests.append(digest.hexdigest())
        columns = [pa.array(c, pa.int64()) for c in (lengths, n_removed, n_spans)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns, pa.array(digests, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removed_spans(documents: DataFrame) -> DataFrame:
    """(order_id, h1, whole, first, last): what is removed of the text with this id and hash; whole copies at once."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order_id"), text.alias("text"),
        F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"),
    ).where(F.octet_length("text") >= LENGTH)
    keys = rows.select("order_id", "h1", "h2")
    originals = keys.groupBy("h1", "h2").agg(F.min("order_id").alias("original"), F.max("order_id").alias("other")).where("other > original")
    copies = keys.join(originals.select("h1", "h2", "original"), ["h1", "h2"]).where("order_id > original").select("order_id", "h1").distinct()
    placed = contexts(rows).repartition("anchor").sortWithinPartitions("anchor", "context", "order_id", "h1", "start")
    spans = placed.mapInArrow(_sorted_shards, _SPAN)
    return spans.select("order_id", "h1", F.lit(False).alias("whole"), "first", "last").union(
        copies.select("order_id", "h1", F.lit(True), F.lit(0).cast("long"), F.lit(0).cast("long"))
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    per = stored(removed_spans(documents), "spans").groupBy("order_id", "h1").agg(
        F.max("whole").alias("whole"), F.collect_list(F.struct("first", "last")).alias("spans")
    )
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text")).withColumns(
        {"order_id": F.coalesce("doc_id", F.lit((1 << 63) - 1)), "h1": F.xxhash64("text")}
    )
    joined = rows.join(per, ["order_id", "h1"], "left").select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
    return joined.mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
