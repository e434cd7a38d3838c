"""Exact Jaccard join of word shingle sets by T-occurrence search over inverted lists.

Equal sets are one class. Every class indexes the first part of its set in one global order, hash order with
frequent shingles last, that is long enough that two linked classes share a known least number of entries in it:
with required overlap t and indexed parts of all but ceil(0.8 n) - 1 shingles, at least
t - max(ceil(0.8 n_a), ceil(0.8 n_b)) + 1. Lists are cut to what a class may link with by size and are sent to the
smaller class, which solves its T-occurrence problem as DivideSkip does: short lists are merged on a heap that
skips, long ones are probed by binary search. What reaches its count is verified on the whole texts.

Groups of near copies would make their lists meet pair by pair. So each list first only proposes its members to
one leader of their size; what is verified joins components, and the search then asks only for links between
different components. No list, partner or candidate is left out.

Defined results: null or blank texts have no shingles and are their own component; fewer than five words are one
shingle; repeated rows are linked like copies; a null doc_id keeps a null component unless linked with a known
one; an empty table gives no rows; further columns are ignored by `linked` and kept by `distinct_documents`.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from monthwise.llm.common import (
    bit_set, components, in_bit_set, lower, mix, pieces, stored, text_bytes, word_bounds, word_hashes,
)

WORDS, PERCENT = 5, 80
#: Shingles indexed by more documents than this go last in the order; they are held as 2^FREQUENT_BITS bits.
FREQUENT, FREQUENT_BITS = 48, 24
#: A leader's members are compared in groups of about this many.
LEADER_ROWS = 1000
#: Queries whose whole sets one verifying step holds.
BLOCK_ROWS = 1000
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of the distinct shingles of every text, by text and shingle."""
    starts, ends, first = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = word_hashes(lower(data), starts, ends)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    parts, owners = [], []
    if len(words) >= WORDS:
        n = len(words) - WORDS + 1
        rolled = words[:n].copy()
        for k in range(1, WORDS):
            rolled = rolled * _STEP + words[k : k + n]
        whole = owner[:n] == owner[WORDS - 1 :]
        parts.append(mix(rolled[whole], WORDS))
        owners.append(owner[:n][whole])
    for c in range(1, WORDS):
        few = np.flatnonzero(counts == c)
        rolled = words[first[few]].copy() if len(few) else np.zeros(0, np.uint64)
        for k in range(1, c):
            rolled = rolled * _STEP + words[first[few] + k]
        parts.append(mix(rolled, c))
        owners.append(few)
    owner, values = np.concatenate(owners), np.concatenate(parts)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    return owner[new], values[new]


def _digests(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and 96-bit digest of every set."""
    first = np.searchsorted(owner, np.arange(n + 1))
    sums = []
    for salt in (11, 12):
        running = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values, salt), out=running[1:])
        sums.append(mix(running[first[1:]] - running[first[:-1]], salt))
    return np.diff(first), sums[0].astype(np.int64), (sums[1] >> np.uint64(33)).astype(np.int32)


def _kept(n: np.ndarray | int) -> np.ndarray | int:
    return -(-PERCENT * n // 100)


def _indexed(owner: np.ndarray, values: np.ndarray, frequent: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The indexed part of every set: its first n - ceil(0.8 n) + 1 shingles in the global order."""
    if frequent is not None:
        order = np.lexsort((values, in_bit_set(frequent, values & np.uint64((1 << 40) - 1), FREQUENT_BITS), owner))
        owner, values = owner[order], values[order]
    if not len(owner):
        return owner, values
    sizes = np.bincount(owner)
    rank = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
    use = rank < (sizes - _kept(sizes) + 1)[owner]
    return owner[use], values[use]


def _over_texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    for i, j in pieces(offsets):
        yield i, j, *shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def _first_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, owner, values in _over_texts(batch["text"]):
            _, use = _indexed(owner, values, None)
            yield pa.RecordBatch.from_arrays([pa.array((use & np.uint64((1 << 40) - 1)).astype(np.int64))], ["shingle"])


def frequent_shingles(documents: DataFrame) -> np.ndarray:
    """Bits of the shingles that more than FREQUENT documents would index; a wrong bit only changes the order."""
    counted = documents.select("text").mapInArrow(_first_in_order, "shingle long").groupBy("shingle").count()
    return bit_set(counted.where(F.col("count") > FREQUENT), F.col("shingle"), FREQUENT_BITS)


def set_keys(documents: DataFrame) -> DataFrame:
    """n, h1, h2 of every row, and its columns without the text."""
    carried = documents.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_digests(owner, values, j - i) for i, j, owner, values in _over_texts(batch["text"])] or [(np.zeros(0, int),) * 3]
            n, h1, h2 = (np.concatenate(x) for x in zip(*got, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(n.astype(np.int32)), pa.array(h1.astype(np.int64)), pa.array(h2.astype(np.int32))], [*names, "n", "h1", "h2"]
            )

    names = carried.columns
    schema = carried.schema.add("n", IntegerType()).add("h1", LongType()).add("h2", IntegerType())
    return documents.select(*names, "text").mapInArrow(run, schema)


def index_entries(documents: DataFrame, frequent: Broadcast) -> DataFrame:
    """(shingle, n, h1, h2) of the indexed part of every set, equal sets of a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for i, j, owner, values in _over_texts(batch["text"]):
                n, h1, h2 = _digests(owner, values, j - i)
                new = np.zeros(j - i, bool)
                for k, key in enumerate(zip(h1.tolist(), h2.tolist(), strict=True)):
                    if n[k] and key not in seen:
                        seen.add(key)
                        new[k] = True
                use = new[owner]
                who, values = _indexed(owner[use], values[use], frequent.value)
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(n[who].astype(np.int32)), pa.array(h1[who]), pa.array(h2[who])], ["shingle", "n", "h1", "h2"])

    return documents.select("text").mapInArrow(run, "shingle long, n int, h1 long, h2 int")


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by shingle and class: one for each class, of lists with two classes or more."""
    names = ["shingle", "n", "h1", "h2"]
    held: list[np.ndarray] | None = None  # the last entry so far
    paired = False  # whether it already shares its list with another class
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int64()), pa.array([], pa.int32())], names)
    for batch in batches:
        columns = [batch[c].to_numpy() for c in names]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        s, n, h1, h2 = columns
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        columns = [c[new] for c in columns]
        s = columns[0]
        if not len(s):
            continue
        same = s[1:] == s[:-1]
        keep = np.zeros(len(s), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= paired
        paired = bool(keep[-1])
        held = [c[-1:] for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1][keep[:-1]]) for c in columns], names)
    if held is not None and paired:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names)
    else:
        yield empty


def least_shared(n_a: np.ndarray | int, n_b: np.ndarray | int) -> np.ndarray | int:
    """How many indexed shingles two linked sets of these sizes share at least."""
    need = -(-PERCENT * (n_a + n_b) // (100 + PERCENT))
    return np.maximum(1, need - np.maximum(_kept(n_a), _kept(n_b)) + 1)


def divide_skip(lists: list[list[int]], need: int) -> list[tuple[int, int]]:
    """(id, count) of the ids in at least `need` of the sorted lists."""
    if need > len(lists):
        return []
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    n_long = min(need - 1, int(need / (0.05 * np.log2(longest + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    threshold = need - n_long
    heap = [(x[0], k, 0) for k, x in enumerate(short) if x]
    heapq.heapify(heap)
    found = []
    while len(heap) >= threshold:
        value = heap[0][0]
        taken = []
        while heap and heap[0][0] == value:
            taken.append(heapq.heappop(heap))
        count = len(taken)
        if count >= threshold:
            for x in long:
                at = bisect_left(x, value)
                count += at < len(x) and x[at] == value
            if count >= need:
                found.append((value, count))
            nexts = value + 1
        else:
            # threshold - 1 lists cannot reach the count before the smallest value of the others.
            while heap and len(taken) < threshold - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                break
            nexts = heap[0][0]
        for v, k, at in taken:
            x = short[k]
            at = at + 1 if nexts == value + 1 and v == value else bisect_left(x, nexts, at)
            if at < len(x):
                heapq.heappush(heap, (x[at], k, at))
    return found


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lists sorted by shingle, n, cid: for each class those it may link with that are larger, in other components."""
    names = ["cid", "n", "shingle", "held", "others", "sizes"]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def runs() -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        held: list[np.ndarray] = []
        for batch in batches:
            columns = [batch[c].to_numpy() for c in ("shingle", "n", "cid", "component")]
            if held:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            cuts = np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1
            bounds = [0, *cuts.tolist()]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield int(columns[0][a]), columns[1][a:b], columns[2][a:b], columns[3][a:b]
            held = [c[bounds[-1] :] for c in columns]
        if held:
            yield int(held[0][0]), *held[1:]

    out: list[list] = [[] for _ in names]
    size = 0
    for shingle, n, cid, component in runs():
        if len(n) < 2 or (component == component[0]).all():
            continue
        ends = np.searchsorted(n, n * 100 // PERCENT, "right")
        ends = ends.tolist()
        for k in range(len(n) - 1):
            for a in range(k + 1, ends[k], 4096):
                b = min(ends[k], a + 4096)
                other = component[a:b] != component[k]
                if other.any():
                    out[0].append(cid[k])
                    out[1].append(n[k])
                    out[2].append(shingle)
                    out[3].append(len(n))
                    out[4].append(cid[a:b][other].astype(np.int64).tobytes())
                    out[5].append(n[a:b][other].astype(np.int32).tobytes())
                    size += 12 * int(other.sum()) + 40
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names)
                out, size = [[] for _ in names], 0
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names)


#: Sizes of the larger class, over that of the smaller, between which one count threshold holds.
_BANDS = (1.0, 1.03, 1.07, 1.12, 1.18, 1.2501)


def _occurrences(n: int, lists: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[int]:
    """Ids that share enough of the lists with a class of size n."""
    for low, high in zip(_BANDS[:-1], _BANDS[1:], strict=True):
        own, known = [], {}
        for ids, sizes in lists:
            use = (sizes >= low * n) & (sizes < high * n)
            if use.any():
                own.append(np.sort(ids[use]).tolist())
                known |= dict(zip(ids[use].tolist(), sizes[use].tolist(), strict=True))
        if own:
            # Roundings make the bound rise with the size in places, so the largest size does not give the least.
            least = least_shared(n, np.unique(np.fromiter(known.values(), np.int64)))
            for other, count in divide_skip(own, int(least.min())):
                if count >= least_shared(n, known[other]):
                    yield other


_FOUND = "key long, cid long, others binary"


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of list parts sorted by the class they were sent to: that class and those that reach the required count with it.

    `key` is the shingle of the longest list the class is in, so the queries of one group of copies mostly have one key.
    """
    held: tuple[int, int] | None = None
    longest = (0, 0)
    lists: list[tuple[np.ndarray, np.ndarray]] = []

    def answer(out: list[tuple]) -> None:
        others = sorted(_occurrences(held[1], lists))
        if others:
            out.append((longest[1], held[0], np.array(others, np.int64).tobytes()))

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["key", "cid", "others"])

    for batch in batches:
        out: list[tuple] = []
        for cid, n, shingle, length, others, sizes in zip(*(batch[c].to_pylist() for c in ("cid", "n", "shingle", "held", "others", "sizes")), strict=True):
            if held and held[0] != cid:
                answer(out)
                lists, longest = [], (0, 0)
            held, longest = (cid, n), max(longest, (length, shingle))
            lists.append((np.frombuffer(others, np.int64), np.frombuffer(sizes, np.int32)))
        yield rows(out)
    if held:
        out = []
        answer(out)
        yield rows(out)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of search results sorted by key: blocks of up to BLOCK_ROWS queries, each with the classes they found, once."""

    def whole(key: int, part: int, queries: list[int], found: list[bytes]) -> pa.RecordBatch:
        others = np.setdiff1d(np.unique(np.frombuffer(b"".join(found), np.int64)), queries)
        cids = np.concatenate([np.array(queries, np.int64), others])
        n = len(cids)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, key)), pa.array(np.full(n, part, np.int32)), pa.array(cids), pa.array(np.arange(n) >= len(queries))],
            ["leader", "part", "cid", "found"],
        )

    key, part, queries, found = None, 0, [], []
    for batch in batches:
        for k, cid, others in zip(*(batch[c].to_pylist() for c in ("key", "cid", "others")), strict=True):
            if queries and (k != key or len(queries) >= BLOCK_ROWS):
                yield whole(key, part, queries, found)
                queries, found = [], []
                part += 1
            key = k
            queries.append(cid)
            found.append(others)
    if queries:
        yield whole(key, part, queries, found)


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts sorted by block, queries first: links between a block's queries and all its texts that join groups."""
    block, ready = None, False
    sets: list[np.ndarray] = []
    cids: list[int] = []
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        pairs: list[tuple[int, int]] = []
        columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("leader", "part", "cid", "found", "h1", "h2")]

        def against(cid: int, values: np.ndarray, pairs: list = pairs) -> None:
            at = np.minimum(np.searchsorted(shingle, values), len(shingle) - 1)
            at = at[shingle[at] == values]
            n = held[at + 1] - held[at]
            each = np.repeat(held[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.bincount(who[each], minlength=len(sets))
            for q in np.flatnonzero(100 * both >= PERCENT * (sizes + len(values) - both)):
                x, y = root(cids[q]), root(cid)
                if x != y:
                    parent[y] = x
                    pairs.append((cids[q], cid))

        for i, j, owner, values in _over_texts(batch["text"]):
            _, g1, g2 = _digests(owner, values, j - i)
            same = (g1 == columns[4][i:j]) & (g2 == columns[5][i:j])
            first = np.searchsorted(owner, np.arange(j - i + 1)).tolist()
            for k, (key, part, cid, found) in enumerate(zip(*(c[i:j].tolist() for c in columns[:4]), strict=True)):
                if not same[k]:
                    continue
                if (key, part) != block:
                    block, ready, sets, cids, parent = (key, part), False, [], [], {}
                own = values[first[k] : first[k + 1]]
                if not found:
                    if cid not in parent:
                        parent[cid] = cid
                        sets.append(own.copy())
                        cids.append(cid)
                    ready = False
                    continue
                if not ready:
                    sizes = np.array([len(x) for x in sets])
                    merged = np.concatenate(sets)
                    order = np.argsort(merged, kind="stable")
                    who = np.repeat(np.arange(len(sets)), sizes)[order]
                    shingle, held = np.unique(merged[order], return_index=True)
                    held = np.append(held, len(merged))
                    ready = True
                    for q, mine in enumerate(list(sets)):
                        against(cids[q], mine)
                against(cid, own)
        yield _pairs(pairs)


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts sorted by leader and part, the leader's first: (leader, member) pairs that are linked."""
    leader, own = None, None
    for batch in batches:
        pairs = []
        names = ("leader", "part", "cid", "h1", "h2")
        columns = [batch[c].to_numpy() for c in names]
        for i, j, owner, values in _over_texts(batch["text"]):
            _, g1, g2 = _digests(owner, values, j - i)
            same = (g1 == columns[3][i:j]) & (g2 == columns[4][i:j])  # else another text under the same id
            first = np.searchsorted(owner, np.arange(j - i + 1)).tolist()
            for k, (key, part, cid) in enumerate(zip(*(c[i:j].tolist() for c in columns[:3]), strict=True)):
                if not same[k]:
                    continue
                found = values[first[k] : first[k + 1]]
                if cid == key:
                    leader, own = (key, part), found.copy()
                elif leader == (key, part) and PERCENT * max(len(own), len(found)) <= 100 * min(len(own), len(found)):
                    both = int((own[np.minimum(np.searchsorted(own, found), len(own) - 1)] == found).sum())
                    if 100 * both >= PERCENT * (len(own) + len(found) - both):
                        pairs.append((key, cid))
        yield _pairs(pairs)


def verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """The (a, b) pairs of classes whose whole sets are linked; b is compared with a, its leader.

    Only texts that occur in a pair are moved, each next to its leader; leaders with many members are repeated.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select(F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("cid"))
    leaders = parts.select(F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("cid"))
    rows = _with_texts(members.union(leaders), classes, documents)
    placed = rows.repartition("leader", "part").sortWithinPartitions("leader", "part", F.col("cid") != F.col("leader"))
    return placed.mapInArrow(_compared, "a long, b long").distinct()


def _with_texts(places: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows of classes (cid) with their digests and a text; only texts that may be wanted are moved."""
    spark = documents.sparkSession
    wanted = stored(places.join(classes.select("cid", "doc_id", "h1", "h2"), "cid").withColumn("id", F.xxhash64("doc_id")), "wanted")
    bits = spark.sparkContext.broadcast(bit_set(wanted, F.col("id"), 23))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bit_set(bits.value, batch["id"].to_numpy(), 23)))

    texts = documents.select(F.xxhash64("doc_id").alias("id"), F.col("doc_id").alias("own_id"), "text").mapInArrow(needed, "id long, own_id long, text string")
    return wanted.join(texts, "id").where(F.col("doc_id").eqNullSafe(F.col("own_id"))).drop("id", "own_id", "doc_id")


def verified_blocks(found: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """Links (a, b) that join what the search proposed: each text is moved once to a block of queries that found it."""
    placed = found.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(_blocks, "leader long, part int, cid long, found boolean")
    rows = _with_texts(placed, classes, documents)
    return rows.repartition("leader", "part").sortWithinPartitions("leader", "part", "found").mapInArrow(_block_links, "a long, b long").distinct()


def linked(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    out = _labelled(documents.select("doc_id", "text"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _labelled(documents: DataFrame) -> DataFrame:
    """Every row without its text, with its set's n, h1 and h2, its group (null without words) and the group's smallest doc_id."""
    spark = documents.sparkSession
    keys = stored(set_keys(documents), "set-keys")
    classes = stored(
        keys.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("doc_id")).withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    frequent = spark.sparkContext.broadcast(frequent_shingles(documents))
    entries = index_entries(documents, frequent)
    entries = entries.repartition("shingle").sortWithinPartitions("shingle", "n", "h1", "h2").mapInArrow(_shared_only, entries.schema)
    lists = stored(stored(entries, "entries").join(classes.select("n", "h1", "h2", "cid"), ["n", "h1", "h2"]).select("shingle", "n", "cid"), "lists")

    # Each list proposes its members to a leader of about their size: the member that shares most of what it indexes,
    # as the text that the others were copied from does. Two divisions by size keep close sizes together.
    shared = lists.groupBy("cid", "n").agg((F.count("*") / (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)).alias("share"))
    lists_by_share = stored(lists.join(shared.select("cid", "share"), "cid"), "lists-by-share")
    scale = F.log(F.col("n")) / F.log(F.lit(1.25))
    bands = F.explode(F.array(F.struct(F.lit(0).alias("way"), F.floor(scale).alias("band")), F.struct(F.lit(1).alias("way"), F.floor(scale + 0.5).alias("band"))))
    banded = lists_by_share.select("*", bands.alias("size")).select("shingle", "n", "cid", "share", "size.way", "size.band")
    led = banded.groupBy("shingle", "way", "band").agg(F.max(F.struct("share", F.negative("cid").alias("low"), "n")).alias("lead"), F.count("*").alias("held")).where("held > 1")
    led = led.select("shingle", "way", "band", F.negative("lead.low").alias("a"), F.col("lead.n").alias("n_a"))
    proposed = (
        banded.join(led, ["shingle", "way", "band"]).where("cid <> a")
        .groupBy("way", "a", F.col("cid").alias("b"), "n_a", F.col("n").alias("n_b")).count()
    )
    kept = lambda c: f"ceil({PERCENT} * {c} / 100)"
    least = F.expr(f"ceil({PERCENT} * (n_a + n_b) / {100 + PERCENT}) - greatest({kept('n_a')}, {kept('n_b')}) + 1")
    near = stored(verified(proposed.where(F.col("count") * 2 >= least), classes, documents), "links")
    groups = components(near)

    grouped = lists.join(groups, lists["cid"] == groups["node"], "left").select("shingle", "n", "cid", F.coalesce("component", "cid").alias("component"))
    asked = grouped.repartition("shingle").sortWithinPartitions("shingle", "n", "cid").mapInArrow(_queries, "cid long, n int, shingle long, held long, others binary, sizes binary")
    found = asked.repartition("cid").sortWithinPartitions("cid").mapInArrow(_searched, _FOUND)
    links = near.union(verified_blocks(found, classes, documents))
    final = components(links)
    labelled = classes.join(final, classes["cid"] == final["node"], "left").withColumn("group", F.coalesce("component", "cid"))
    smallest = labelled.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    by_class = labelled.select("n", "h1", "h2", "group").join(smallest, "group")
    return keys.join(by_class, ["n", "h1", "h2"], "left")


def distinct_documents(documents: DataFrame) -> DataFrame:
    """The documents with one text of each group of links: that of its smallest doc_id (null last, ties by digest).

    Rows are told apart by doc_id and the digest of their text, so another text under the same id is judged by itself
    and null ids are compared like others. Rows equal in both stay once. Texts without words are never linked.
    """
    columns = documents.columns
    mark, own_id, own_mark = "_text_mark", "_own_id", "_own_mark"
    marked = documents.withColumn(mark, F.unhex(F.sha2("text", 256)))
    labels = stored(_labelled(marked.select("doc_id", mark, "text")).select("doc_id", mark, "group"), "components")
    grouped = labels.where("group is not null")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", mark)
    first = grouped.groupBy("group").agg(F.min(order).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col(mark) == F.col(f"first.{mark}"))
    named = lambda f: f.select(F.col("doc_id").alias(own_id), F.col(mark).alias(own_mark))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & F.col(mark).eqNullSafe(F.col(own_mark))
    gone = named(grouped.join(first, "group").where(~stays)).distinct()
    repeated = stored(named(labels.groupBy("doc_id", mark).count().where("count > 1")), "repeated")
    kept = marked.join(gone, same, "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", mark])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.select(*columns)
