"""Benchmark decontamination by CGK embeddings and bit-sampling LSH, verified by exact edit distance.

A CGK walk turns a window of bytes into a longer string whose Hamming distance reflects the edit distance of the
windows: at each step it copies the current byte and a random bit, fixed by step and byte, says whether to go on.
Windows are short beside an item and overlap: those of a text begin at every multiple of a stride, those of an item at
every byte, so that some window of an edited passage meets few edits. A table samples a few steps of the walk. The
sizes, by length of the item, are those of PLANS, which reach RECALL for passages edited by all of EDIT_RATE; the
test measures it against brute force. Of long items two windows of a text must meet the item at places that edits
within the rate can explain. Overlapping places of an item become one. Candidates go through bit-parallel edit
distances of many places at once, first of single parts of the item, then of the item, which lose nothing, and then
meet the whole item in an exact search for its best match around the place.

The benchmark goes to the tasks in blocks of at most `block_bytes` of text; each block is one pass.

Texts and items are compared in UTF-8 with A-Z lower-cased and white space as blanks. Defined results: null or
empty texts and items match nothing; an item under 16 bytes is searched as one exact string; equal items are
reported each; repeated documents are reported each; an empty table gives no rows; further columns are ignored by
`leaks` and kept by `clean`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import _LOWER, _SPACE, pieces, text_bytes

#: A passage leaks if at most this share of the item's bytes must be edited.
EDIT_RATE = 0.2
#: The share of passages at EDIT_RATE that is to be found, for every length class from 16 bytes on.
RECALL = 0.95
WALKS = 3


@dataclass(frozen=True)
class Plan:
    """How items of `least` bytes or more are sought; text windows begin at multiples of `stride`."""

    least: int
    window: int
    stride: int
    tables: int
    samples: int
    hits: int


PLANS = (
    Plan(16, 8, 1, 2, 6, 1), Plan(24, 12, 2, 2, 6, 1), Plan(32, 16, 2, 3, 7, 1),
    Plan(64, 24, 4, 4, 8, 1), Plan(96, 24, 4, 4, 8, 2), Plan(128, 24, 8, 4, 10, 2),
)
_NORMAL = np.where(_SPACE, 32, _LOWER).astype(np.uint8)
_FILTER_BITS = 20
#: Hits expanded, places compared, and windows walked, at once.
_HITS, _PLACES, _WINDOWS = 1 << 22, 4096, 1 << 16
#: Fewer places than this are left to the exact search.
_FEW = 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def walk_marks(walk: int, steps: int) -> np.ndarray:
    """For each byte the byte itself, from bit 8 on whether each step of the walk moves on, and random bits (256)."""
    r = np.random.default_rng([31, walk])
    moves = r.integers(0, 2, (steps, 256)).astype(np.uint64)
    marks = np.arange(256, dtype=np.uint64) | r.integers(0, 1 << (56 - steps), 256, np.uint64) << np.uint64(8 + steps)
    for j, own in enumerate(moves):
        marks |= own << np.uint64(8 + j)
    return marks


def sampled_steps(walk: int, plan: Plan) -> np.ndarray:
    """The sampled steps of each table (tables, samples), one from each equal part of the walk.

    The walk takes 1.5 steps for each byte of the window, so it nearly never leaves it.
    """
    steps, r = plan.window * 3 // 2, np.random.default_rng([47, walk, plan.window, plan.samples])
    bounds = np.linspace(0, steps, plan.samples + 1).astype(int)
    return np.stack([r.integers(bounds[:-1], np.maximum(bounds[1:], bounds[:-1] + 1)) for _ in range(plan.tables)])


def walked(data: np.ndarray, starts: np.ndarray, walk: int, plans: list[Plan], counts: list[int]) -> list[np.ndarray]:
    """Table keys (tables, count) of the first windows for each plan of one window size; `data` is padded by 1.5 windows."""
    steps = plans[0].window * 3 // 2
    marked, chosen = walk_marks(walk, steps)[data], [sampled_steps(walk, plan) for plan in plans]
    out = [np.zeros((plan.tables, count), np.uint64) for plan, count in zip(plans, counts, strict=True)]
    edges = sorted({*counts, *range(0, max(counts), _WINDOWS)})
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        rows: list[list[np.ndarray]] = [[] for _ in range(steps)]
        for keys, own, count in zip(out, chosen, counts, strict=True):
            if a < count:
                for key, sampled in zip(keys, own, strict=True):
                    for j in sampled:
                        rows[j].append(key[a:b])
        at, mark = starts[a:b].astype(np.int64), np.empty(b - a, np.uint64)
        for j in range(max(j for j in range(steps) if rows[j]) + 1):
            np.take(marked, at, out=mark, mode="clip")
            for row in rows[j]:
                row *= _FACTOR
                row += mark
            mark >>= np.uint64(8 + j)
            mark &= np.uint64(1)
            at += mark.view(np.int64)
    return out


@dataclass
class Item:
    item_id: int | None
    text: bytes
    peq: dict[int, int]
    hits: int = 1


def _sought(plan: Plan) -> tuple[int, ...]:
    return plan.window, plan.stride, plan.tables, plan.samples


class Index:
    """Keys of all shifts of the items, by window size, plan, walk and table."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items, self.short, by = [], [], {}
        for item_id, text in items:
            peq: dict[int, int] = {}
            for k, c in enumerate(text):
                peq[c] = peq.get(c, 0) | 1 << k
            self.items.append(Item(item_id, text, peq))
            if len(text) < 16:
                self.short.append(len(self.items) - 1)
            else:
                plan = [p for p in PLANS if p.least <= len(text)][-1]
                self.items[-1].hits = plan.hits
                by.setdefault(_sought(plan), (plan, []))[1].append(len(self.items) - 1)
        self.lengths = np.array([len(x.text) for x in self.items], np.int64)
        self.hits = np.array([x.hits for x in self.items], np.int64)
        self.windows: dict[int, list[Plan]] = {}
        self.tables: dict[tuple[Plan, int], list[tuple[np.ndarray, ...]]] = {}
        for plan, members in by.values():
            window = plan.window
            self.windows.setdefault(window, []).append(plan)
            data = np.concatenate([np.concatenate([np.frombuffer(self.items[m].text, np.uint8), np.zeros(2 * window, np.uint8)]) for m in members])
            base = np.cumsum([0, *(len(self.items[m].text) + 2 * window for m in members)])[:-1]
            shifts = [np.arange(len(self.items[m].text) - window + 1) for m in members]
            starts = np.concatenate([b + s for b, s in zip(base, shifts, strict=True)])
            who, shift = np.repeat(members, [len(s) for s in shifts]), np.concatenate(shifts)
            for walk in range(WALKS):
                got = []
                for key in walked(data, starts, walk, [plan], [len(starts)])[0]:
                    order = np.argsort(key, kind="stable")
                    seen = np.zeros(1 << _FILTER_BITS, bool)
                    seen[(key >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
                    got.append((seen, key[order], who[order], shift[order]))
                self.tables[plan, walk] = got


def best_match(item: Item, text: bytes) -> tuple[int, int]:
    """Least edit distance of the item to any substring of the text, and the first end that attains it."""
    m = len(item.text)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for k, c in enumerate(text):
        eq = item.peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full  # a match may begin anywhere
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, k + 1
    return best, end


def parts_match(index: Index, data: np.ndarray, first: np.ndarray, last: np.ndarray, numbers: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether the 64-byte parts of each item, each at its best within data[first:last], come to at most `most` edits.

    No match needs fewer edits than its parts, so this loses none. A part is sought only where a match that lies in the
    range can hold it. Items of one word pass unseen, as do the last few places.
    """
    out, lengths, spent = np.ones(len(first), bool), index.lengths[numbers], np.zeros(len(first), np.int64)
    one = np.uint64(1)
    for part in range(int(lengths.max(initial=0)) // 64):
        at = 64 * part
        live = np.flatnonzero(out & (lengths > 64) & (lengths >= at + 64))
        if len(live) < _FEW:
            break
        begins = first[live] + np.maximum(0, at - most[live])
        ends = np.maximum(begins, last[live] - np.maximum(0, lengths[live] - at - 64 - most[live]))
        order = np.argsort(begins - ends, kind="stable")
        for k in range(0, len(live), _PLACES):
            own, begin, end = (x[order[k : k + _PLACES]] for x in (live, begins, ends))
            active = np.cumsum(np.bincount(end - begin)[::-1])[::-1]  # places of at least so many bytes
            used, which = np.unique(numbers[own], return_inverse=True)
            peq = np.zeros((len(used), 256), np.uint64)
            for u, number in enumerate(used.tolist()):
                for c, bits in index.items[number].peq.items():
                    peq[u, c] = bits >> at & (1 << 64) - 1
            peq, row = peq.ravel(), which.astype(np.int64) * 256
            score = np.full(len(own), 64, np.int64)
            best = score.copy()
            pv, mv = np.full(len(own), (1 << 64) - 1, np.uint64), np.zeros(len(own), np.uint64)
            for step, n in enumerate(active[1:].tolist()):
                pv, mv, score = pv[:n], mv[:n], score[:n]
                eq = peq[row[:n] + data[begin[:n] + step]]
                xh = (((eq & pv) + pv) ^ pv) | eq
                ph = mv | ~(xh | pv)
                mh = pv & xh
                score += (ph >> np.uint64(63)).view(np.int64)
                score -= (mh >> np.uint64(63)).view(np.int64)
                ph <<= one
                mh <<= one
                eq |= mv
                pv = mh | ~(eq | ph)
                mv = ph & eq
                np.minimum(best[:n], score, out=best[:n])
            spent[own] += best
        out = spent <= most
    return out


def may_match(index: Index, data: np.ndarray, first: np.ndarray, last: np.ndarray, numbers: np.ndarray, most: np.ndarray, few: int = 0) -> np.ndarray:
    """Whether each item comes within `most` edits of a substring of data[first:last], many places at a time.

    Bit-parallel in words of 64 bytes; a place may be read past its end, so some without a match stay. So do groups of
    items of one size with fewer than `few` places.
    """
    out = np.zeros(len(first), bool)
    words = (index.lengths[numbers] + 63) // 64
    order = np.lexsort((last - first, words))
    cuts = np.flatnonzero(np.diff(words[order])) + 1
    one = np.uint64(1)
    for group in np.split(order, cuts):
        if len(group) < few:
            out[group] = True
            continue
        for at in range(0, len(group), _PLACES):
            own = group[at : at + _PLACES]
            count = int(words[own[0]])
            used, which = np.unique(numbers[own], return_inverse=True)
            peq = np.zeros((count, len(used), 256), np.uint64)
            for u, number in enumerate(used.tolist()):
                for c, bits in index.items[number].peq.items():
                    for w in range(count):
                        peq[w, u, c] = bits >> 64 * w & (1 << 64) - 1
            peq = peq.reshape(count, -1)
            row = which.astype(np.int64) * 256
            score = index.lengths[numbers[own]].copy()
            top = ((score - 1) % 64).astype(np.uint64)
            best = score.copy()
            pv = [np.full(len(own), (1 << 64) - 1, np.uint64) for _ in range(count)]
            mv = [np.zeros(len(own), np.uint64) for _ in range(count)]
            begin = first[own]
            for step in range(int((last[own] - begin).max())):
                symbol = row + data[np.minimum(begin + step, len(data) - 1)]
                up = down = np.zeros(len(own), np.uint64)
                for w in range(count):
                    eq = peq[w][symbol]
                    xv = eq | mv[w]
                    eq |= down
                    xh = (((eq & pv[w]) + pv[w]) ^ pv[w]) | eq
                    ph = mv[w] | ~(xh | pv[w])
                    mh = pv[w] & xh
                    if w == count - 1:
                        score += (ph >> top & one).astype(np.int64) - (mh >> top & one).astype(np.int64)
                    next_up, next_down = ph >> np.uint64(63), mh >> np.uint64(63)
                    ph = ph << one | up
                    pv[w] = mh << one | down | ~(xv | ph)
                    mv[w] = ph & xv
                    up, down = next_up, next_down
                np.minimum(best, score, out=best)
            out[own] = best <= most[own]
    return out


def _places(index: Index, data: np.ndarray, offsets: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, item number, place where the item would begin) of all candidates, places in steps of 8 bytes.

    Strides of one window size divide one another, so the windows of a plan come before those of smaller strides only.
    """
    lengths, found = np.diff(offsets), [np.zeros((4, 0), np.int64)]
    for window, plans in index.windows.items():
        stride = min(plan.stride for plan in plans)
        counts = np.maximum(0, (lengths - window) // stride + 1)
        owner = np.repeat(np.arange(len(lengths)), counts)
        within = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
        strides = sorted({plan.stride for plan in plans})
        order = np.argsort(-sum((within % s == 0).astype(np.int8) for s in strides), kind="stable")
        owner, within = owner[order], within[order]
        padded = np.concatenate([data, np.zeros(2 * window, np.uint8)])
        starts = offsets[:-1][owner] + within
        counts = [int(np.count_nonzero(within % plan.stride == 0)) for plan in plans]
        for walk in range(WALKS):
            for plan, keys in zip(plans, walked(padded, starts, walk, plans, counts), strict=True):
                for key, (seen, sorted_keys, who, shift) in zip(keys, index.tables[plan, walk], strict=True):
                    hit = np.flatnonzero(seen[(key >> np.uint64(64 - _FILTER_BITS)).view(np.int64)])
                    lo = np.searchsorted(sorted_keys, key[hit], "left")
                    n = np.searchsorted(sorted_keys, key[hit], "right") - lo
                    hit, lo, n = hit[n > 0], lo[n > 0], n[n > 0]
                    total = np.cumsum(n)
                    a = 0
                    while a < len(hit):
                        b = max(a + 1, int(np.searchsorted(total, total[a] - n[a] + _HITS, "right")))
                        each = np.repeat(lo[a:b] - np.cumsum(n[a:b]) + n[a:b], n[a:b]) + np.arange(n[a:b].sum())
                        h = np.repeat(hit[a:b], n[a:b])
                        got = np.stack([owner[h], who[each], (within[h] - shift[each]) // 8, within[h]])
                        found.append(_distinct(got) if got.shape[1] > _HITS // 8 else got)
                        a = b
    text, number, begin, within = _distinct(np.concatenate(found, 1))
    # Of items that need two hits: those with a neighbour from another window within the edits that are allowed.
    near = (text[1:] == text[:-1]) & (number[1:] == number[:-1]) & (within[1:] != within[:-1])
    near &= (begin[1:] - begin[:-1] - 1) * 8 <= index.lengths[number[1:]] * rate
    keep = index.hits[number] == 1
    keep[1:] |= near
    keep[:-1] |= near
    text, number, begin, _ = _distinct(np.stack([text[keep], number[keep], begin[keep], begin[keep]]))
    return text, number, begin * 8


def _distinct(rows: np.ndarray) -> np.ndarray:
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
    return rows[:, new]


def _found(index: Index, data: np.ndarray, offsets: np.ndarray, rate: float) -> list[tuple[int, int, int, int]]:
    """(text number, item number, distance, end byte) of the best match of every item that leaks into a text."""
    texts, numbers, begins = _places(index, data, offsets, rate)
    allowed = (index.lengths * rate).astype(np.int64)[numbers]
    firsts = np.maximum(0, begins - allowed - 8)
    lasts = np.minimum(np.diff(offsets)[texts], begins + index.lengths[numbers] + allowed + 16)
    # Neighbours no further apart than the edits that are allowed become one place.
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (numbers[1:] != numbers[:-1]) | (begins[1:] - begins[:-1] > allowed[1:] + 8)
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(texts) - 1)[: int(new.sum())]
    texts, numbers, allowed, firsts, lasts = texts[new], numbers[new], allowed[new], firsts[new], lasts[ends]
    use = np.flatnonzero(parts_match(index, data, offsets[texts] + firsts, offsets[texts] + lasts, numbers, allowed))
    at = offsets[texts[use]]
    use = use[may_match(index, data, at + firsts[use], at + lasts[use], numbers[use], allowed[use], _FEW)]
    places: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for text, number, first, last in zip(*(x[use].tolist() for x in (texts, numbers, firsts, lasts)), strict=True):
        places.setdefault((text, number), []).append((first, last))
    found = []
    for (text, number), regions in sorted(places.items()):
        item = index.items[number]
        most = int(len(item.text) * rate)
        own = data[offsets[text] : offsets[text + 1]].tobytes()
        best = (most + 1, 0)
        for first, last in regions:
            distance, end = best_match(item, own[first:last])
            best = min(best, (distance, first + end))
            if best[0] == 0:
                break
        if best[0] <= most:
            found.append((text, number, *best))
    for number in index.short:
        word = index.items[number].text
        if word:
            for text in range(len(offsets) - 1):
                at = data[offsets[text] : offsets[text + 1]].tobytes().find(word)
                if at >= 0:
                    found.append((text, number, 0, at + len(word)))
    return found


def _scan(column: pa.Array, index: Index, rate: float) -> Iterator[tuple[int, int, int, int]]:
    data, offsets = text_bytes(column)
    for i, j in pieces(offsets):
        part = _NORMAL[data[offsets[i] : offsets[j]]]
        for text, *rest in _found(index, part, offsets[i : j + 1] - offsets[i], rate):
            yield (i + text, *rest)


def blocks(benchmark: DataFrame, block_bytes: int = 4 << 20) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of about `block_bytes`, dealt by hash; one block at a time is on the driver."""
    rows = benchmark.where(F.octet_length("text") > 0).select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    for k in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect() if count > 1 else rows.collect()
        items = [(r["item_id"], _NORMAL[np.frombuffer(r["text"].encode(), np.uint8)].tobytes().strip()) for r in own]
        yield sorted((x for x in items if x[1]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def leaks(documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """(doc_id, item_id, distance, similarity, end_byte) of every item that leaks into a document, best match each."""
    spark = documents.sparkSession
    schema = "doc_id long, item_id long, distance int, similarity double, end_byte long"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                ids = batch["doc_id"].to_pylist()
                rows = [(ids[t], index.items[k].item_id, d, 1 - d / len(index.items[k].text), end) for t, k, d, end in _scan(batch["text"], index, rate)]
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                types = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "distance", "similarity", "end_byte"])

        out = out.union(documents.select("doc_id", "text").mapInArrow(run, schema))
    return out


def clean(documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The documents, unchanged, into which no item leaks."""
    spark = documents.sparkSession
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[t for t, *_ in _scan(batch["text"], index, rate)]] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
