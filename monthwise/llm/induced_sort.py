"""Suffix order with common prefixes by induced sorting, with queues that go to disk when they grow.

Sorted LMS suffixes (each a valley in the sense of the next suffix) seed two passes. The first goes up through the
first bytes: what is taken from the queue of a byte puts its predecessor, if that is larger, into the queue of the
predecessor's byte; the second goes down and does the same for the smaller ones. Every queue receives its suffixes
in order, so a queue per byte is the priority queue. Tuples carry the length of the prefix shared with the suffix
before, found as one more than the least such length taken since the last suffix that went to the same queue.

Only `depth` bytes matter to the caller, so seeds are ordered by that many and lengths stop there.
"""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np

#: Queued tuples a queue keeps in memory; more are appended to its file.
QUEUE_ROWS = 1 << 18
_TUPLE = np.dtype([("at", "<i4"), ("lcp", "<i2")])


class Queues:
    """One first-in-first-out queue of tuples for each byte."""

    def __init__(self, rows: int = QUEUE_ROWS):
        self.rows, self.folder = rows, None
        self.held: list[list[np.ndarray]] = [[] for _ in range(257)]
        self.count, self.spilled = [0] * 257, [0] * 257

    def put(self, byte: int, tuples: np.ndarray) -> None:
        self.held[byte].append(tuples)
        self.count[byte] += len(tuples)
        if self.count[byte] > self.rows:
            if self.folder is None:
                self.folder = tempfile.mkdtemp(prefix="queues-")
            with open(os.path.join(self.folder, str(byte)), "ab") as f:
                for x in self.held[byte]:
                    f.write(x.tobytes())
            self.spilled[byte] += self.count[byte]
            self.held[byte], self.count[byte] = [], 0

    def take(self, byte: int) -> np.ndarray | None:
        """The oldest tuples, at most about `rows`, or None."""
        if self.spilled[byte]:
            path = os.path.join(self.folder, str(byte))
            first = os.path.getsize(path) // _TUPLE.itemsize - self.spilled[byte]
            n = min(self.rows, self.spilled[byte])
            out = np.fromfile(path, _TUPLE, n, offset=first * _TUPLE.itemsize)
            self.spilled[byte] -= n
            if not self.spilled[byte]:
                os.remove(path)
            return out
        if not self.held[byte]:
            return None
        out = np.concatenate(self.held[byte])
        self.held[byte], self.count[byte] = [], 0
        return out

    def close(self) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)


def _tuples(at: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    out = np.empty(len(at), _TUPLE)
    out["at"], out["lcp"] = at, lcp
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last suffix, before the end, is larger."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=np.int16(-1)))
    at = np.where(step != 0, np.arange(n), n)
    ahead = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the byte changes
    return step[ahead] > 0


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as numbers that compare as the bytes do."""
    n = len(text) - 7
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= text[k : k + n]
    return out


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Shared prefix lengths of suffix pairs, up to `depth`; `words` are those of a text padded by `depth` bytes and more."""
    out = np.full(len(a), depth)
    live = np.arange(len(a))
    for first in range(0, depth, 8):
        if not len(live):
            break
        unlike = words[a[live] + first] ^ words[b[live] + first]
        ended = unlike != 0
        unlike = unlike[ended]
        out[live[ended]] = first + sum((unlike < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
        live = live[~ended]
    return np.minimum(out, depth)


def _push(queues: Queues, text: np.ndarray, taken: np.ndarray, wanted: np.ndarray, since: np.ndarray, depth: int) -> None:
    """Puts wanted predecessors of taken suffixes into the queue of their byte."""
    before = taken["at"].astype(np.int64) - 1
    ok = before >= 0
    ok[ok] = wanted[before[ok]]
    at = np.flatnonzero(ok)
    lcp = taken["lcp"]
    least = int(lcp.min())
    if len(at):
        byte = text[before[at]]
        order = np.argsort(byte, kind="stable")
        cuts = np.flatnonzero(np.diff(byte[order])) + 1
        seen = np.zeros(257, bool)
        for own in np.split(at[order], cuts):
            c = int(text[before[own[0]]])
            seen[c] = True
            starts = np.concatenate([[0], own + 1])
            last = starts[-1] == len(lcp)
            least_between = np.minimum.reduceat(lcp, starts[:-1] if last else starts)
            shared = least_between[: len(own)].astype(np.int64)
            shared[0] = min(shared[0], since[c])
            since[c] = depth if last else least_between[-1]
            queues.put(c, _tuples(before[own], np.minimum(shared + 1, depth)))
        since[~seen] = np.minimum(since[~seen], least)
    else:
        np.minimum(since, least, out=since)


def suffix_order(text: np.ndarray, depth: int, queue_rows: int = QUEUE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of bytes in order of their first `depth` bytes, and the prefix each shares with the one before."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int16)
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    small = smaller_than_next(text)
    valley = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    # Seeds in order of their first `depth` bytes, as many at a time as fit beside a group's number; only what is still
    # tied goes on.
    words = words_of(padded)
    rank = np.zeros(len(valley), np.int64)
    tied = np.arange(len(valley))
    first = 0
    while first < depth + 8 and len(tied):
        old, places = rank[tied], np.arange(len(tied))
        group = np.ones(len(tied), bool)
        group[1:] = old[1:] != old[:-1]
        number = np.cumsum(group) - 1
        count = (64 - int(number[-1]).bit_length()) // 8
        key = words[valley[tied] + first] >> np.uint64(64 - 8 * count)
        if count < 8:
            key |= number.astype(np.uint64) << np.uint64(8 * count)
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.maximum.accumulate(np.where(new, places, 0))
        group_begin = np.maximum.accumulate(np.where(group, places, 0))
        rank[tied] = old + begin - group_begin
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        first += count
    seeds = valley[np.argsort(rank, kind="stable")]
    seed_lcp = np.zeros(len(seeds), np.int64)
    seed_lcp[1:] = common_prefix(words, seeds[:-1], seeds[1:], depth)
    seed_byte = text[seeds]

    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    queues, since = Queues(queue_rows), np.zeros(257, np.int64)
    last = -1  # the suffix taken before

    def joined(taken: np.ndarray) -> np.ndarray:
        nonlocal last
        taken = taken.copy()
        now = int(taken["at"][0])
        unlike = padded[last : last + depth] != padded[now : now + depth] if last >= 0 else np.ones(1, bool)
        taken["lcp"][0] = unlike.argmax() if unlike.any() else depth
        last = int(taken["at"][-1])
        return taken

    try:
        # The end of the text is smaller than any suffix, so its predecessor opens the first pass.
        queues.put(int(text[-1]), _tuples(np.array([n - 1]), np.array([0])))
        for byte in range(256):
            while (taken := queues.take(byte)) is not None:
                taken = joined(taken)
                larger[byte].append(taken)
                _push(queues, text, taken, ~small, since, depth)
            own = slice(*np.searchsorted(seed_byte, [byte, byte + 1]))
            if own.start < own.stop:
                _push(queues, text, joined(_tuples(seeds[own], seed_lcp[own])), ~small, since, depth)
        queues.close()
        smaller: list[list[np.ndarray]] = [[] for _ in range(256)]
        queues, since, last = Queues(queue_rows), np.zeros(257, np.int64), -1
        for byte in range(255, -1, -1):
            while (taken := queues.take(byte)) is not None:
                taken = joined(taken)
                smaller[byte].append(taken)
                _push(queues, text, taken, small, since, depth)
            for part in reversed(larger[byte]):
                # Downwards, a suffix shares with the one taken before what that one shared with it.
                down = part[::-1].copy()
                down["lcp"][1:] = part["lcp"][:0:-1]
                _push(queues, text, joined(down), small, since, depth)
    finally:
        queues.close()
    order = np.concatenate([np.concatenate([*[x["at"] for x in larger[b]], *[x["at"][::-1] for x in reversed(smaller[b])], np.zeros(0, np.int32)]) for b in range(256)])
    lcp = np.zeros(n, np.int64)
    at = 0
    for b in range(256):
        for x in larger[b]:
            lcp[at : at + len(x)] = x["lcp"]
            at += len(x)
        for x in reversed(smaller[b]):
            lcp[at + 1 : at + len(x)] = x["lcp"][:0:-1]
            at += len(x)
    # Between parts of a bucket the prefix was not carried.
    sizes = [len(x) for b in range(256) for x in [*larger[b], *reversed(smaller[b])]]
    edges = np.cumsum([0, *sizes])[1:-1]
    lcp[edges] = common_prefix(words, order[edges - 1].astype(np.int64), order[edges].astype(np.int64), depth)
    return order, lcp
