"""Spelling variants: vocabulary acceptor, one-edit transducer and acceptor again, composed per initial state.

Two words one edit apart share a left or a right part whose size follows from the place of the edit. So words are
dealt by (length of the shorter word, left part, right part): the state that the acceptor has after the left part, with
the right part fixed, is the initial state of a partition. A partition holds the minimised acceptor of what lies between
the parts; composing it with the transducer and itself gives states (p, p) before the edit and (p, q) after it, and the
paths of these states to final ones are the pairs. Partitions of more than `MOST_WORDS` words are cut again at the
middle of what lies between, until they are small or one letter is left, so no partition grows with the vocabulary.

Defined results: null and empty texts have no words; a null doc_id is an empty string in the crc32 key. Repeated rows
count again. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import stored

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form occurs at least this many times as often as its variant.
FORM_RATIO = 5
#: A run loses a letter if this divides its hash.
DROP_DIVISOR = 199
LETTERS = "[A-Za-zÀ-ÿ]"
#: Words of one partition.
MOST_WORDS = 20_000
#: Every form is at least FORM_RATIO times as frequent as its word, so 27 steps pass 2^63 and 5 doublings pass 27 steps.
MOST_DOUBLINGS = 6
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["m", "a", "b", "head", "tail"]


def vocabulary(documents: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of all texts, after a letter of some runs is left out. Counts combine before the shuffle."""
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_letters},}}"), F.lit(0))).alias("run"),
    )
    # Few runs hold a capital, and translate costs far more than the test for one.
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _UPPER.lower())).otherwise(F.col("run")))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = "cast(h % char_length(run) as int)"
    word = F.when(F.col("h") % DROP_DIVISOR == 0, F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# Acceptor and composition


class Acceptor:
    """Minimal acyclic acceptor of sorted different words: equal right languages are one state."""

    def __init__(self, words: list[str]) -> None:
        self.edges: list[tuple[tuple[str, int], ...]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]
        labels: list[str] = []
        before = ""
        for word in words:
            same = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                same += 1
            self._close(path, labels, same)
            for letter in word[same:]:
                labels.append(letter)
                path.append([False, []])
            path[-1][0] = True
            before = word
        self._close(path, labels, 0)
        self.root = self._state(path[0])

    def _state(self, node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in self._known:
            self._known[key] = len(self.edges)
            self.edges.append(key[1])
            self.final.append(key[0])
        return self._known[key]

    def _close(self, path: list[list], labels: list[str], depth: int) -> None:
        while len(path) - 1 > depth:
            state = self._state(path.pop())
            path[-1][1].append((labels.pop(), state))


def composed_pairs(acceptor: Acceptor) -> Iterator[tuple[str, str]]:
    """Accepted pairs of acceptor, one-edit transducer, acceptor: (longer or smaller, other), each at least once.

    Before the edit both sides read the same letters and so are in one state. The edit replaces a letter by a
    larger one or leaves one out on the right side (the other direction is the same pair turned round). State
    pairs after the edit that reach no final pair are remembered and not entered again.
    """
    dead: set[tuple[int, int]] = set()

    def rests(p: int, q: int) -> Iterator[str]:
        if (p, q) in dead:
            return
        stack, found = [(p, q, "")], False
        while stack:
            p1, q1, rest = stack.pop()
            if acceptor.final[p1] and acceptor.final[q1]:
                found = True
                yield rest
            right = dict(acceptor.edges[q1])
            stack += [(p2, right[c], rest + c) for c, p2 in acceptor.edges[p1] if c in right and (p2, right[c]) not in dead]
        if not found:
            dead.add((p, q))

    stack = [(acceptor.root, "")]
    while stack:
        state, read = stack.pop()
        edges = acceptor.edges[state]
        for k, (c, p) in enumerate(edges):
            for d, q in edges[k + 1 :]:
                for rest in rests(p, q):
                    yield read + c + rest, read + d + rest
            for rest in rests(p, state):
                yield read + c + rest, read + rest
            stack.append((p, read + c))


# Partitions


def _halves(frame: DataFrame) -> DataFrame:
    """The two partitions of each word for an edit right and left of the middle of what lies between its parts."""
    cut = F.expr("explode(array(named_struct('a', a + (m - a - b) div 2, 'b', b), named_struct('a', a, 'b', m - a - (m - a - b) div 2)))")
    halves = frame.select("word", "n", "m", cut.alias("part")).selectExpr("word", "n", "m", "cast(part.a as int) as a", "cast(part.b as int) as b")
    return halves.selectExpr("*", "substring(word, 1, a) as head", "right(word, b) as tail")


def partitioned(words: DataFrame, least_letters: int = LEAST_LETTERS, most_words: int = MOST_WORDS) -> DataFrame:
    """word, n and the key of each partition in which a word meets words one edit away."""
    shorter = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("m")
    frame = words.select("word", "n", shorter).where(F.col("m") >= least_letters).selectExpr("*", "0 as a", "0 as b")
    frame, small = stored(_halves(frame), "partitions"), None
    while True:
        large = stored(frame.groupBy(*_KEY).count().where((F.col("count") > most_words) & (F.expr("m - a - b") > 1)).select(*_KEY), "large-partitions")
        if large.isEmpty():
            return frame if small is None else small.unionByName(frame)
        rest = frame.join(large, _KEY, "left_anti").select(frame.columns)
        small = rest if small is None else small.unionByName(rest)
        frame = stored(_halves(frame.join(large, _KEY, "left_semi")), "partitions")


_PAIRS = pa.schema([("x", pa.string()), ("n_x", pa.int64()), ("y", pa.string()), ("n_y", pa.int64())])
_BATCH = 10_000


def _enumerated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each partition; rows come sorted by partition and word."""

    def pairs(key: tuple, counts: dict[str, int]) -> Iterator[tuple]:
        m, a, b, head, tail = key
        between = sorted(w[a : len(w) - b] for w in counts)
        for x, y in composed_pairs(Acceptor(between)):
            if min(len(x), len(y)) + a + b == m:
                x, y = head + x + tail, head + y + tail
                yield x, counts[x], y, counts[y]

    def every() -> Iterator[tuple]:
        now, counts = None, {}
        for batch in batches:
            for *key, word, n in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if key != now:
                    if len(counts) > 1:
                        yield from pairs(now, counts)
                    now, counts = key, {}
                counts[word] = n
        if len(counts) > 1:
            yield from pairs(now, counts)

    rows = []
    for row in every():
        rows.append(row)
        if len(rows) == _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PAIRS, strict=True)], schema=_PAIRS)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PAIRS, strict=True)], schema=_PAIRS)


def near_pairs(words: DataFrame, least_letters: int = LEAST_LETTERS, most_words: int = MOST_WORDS) -> DataFrame:
    """x, n_x, y, n_y of all unordered pairs of words one edit apart, each once."""
    dealt = partitioned(words, least_letters, most_words).select(*_KEY, "word", "n").repartition(*_KEY).sortWithinPartitions(*_KEY, "word")
    return dealt.mapInArrow(_enumerated, "x string, n_x long, y string, n_y long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word that has a form: pointers are doubled until none moves."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_DOUBLINGS):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now
    raise RuntimeError("forms did not settle")


def grouped(documents: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, most_words: int = MOST_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stored(vocabulary(documents, least_letters, least_count), "words")
    pairs = near_pairs(words, least_letters, most_words)
    both = pairs.select(F.expr("inline(array(named_struct('word', x, 'n', n_x, 'near', y, 'near_n', n_y), named_struct('word', y, 'n', n_y, 'near', x, 'near_n', n_x)))"))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct(F.negative("near_n").alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= FORM_RATIO * F.col("n")
    formed = stored(
        best.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms"
    )
    out = words.join(formed, "word", "left").join(roots(formed.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long"))
