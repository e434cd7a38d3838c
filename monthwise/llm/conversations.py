"""Conversation repair: the cheapest edits that give a legal order of roles, proved by branch and bound.

Rows are dealt by conversation once and sorted there by turn; a task then reads its conversations as a stream and
searches them in blocks of `BLOCK` rows. A block is searched depth first with an explicit stack. A node is (rows used,
role state, cost, audit). The sum of the least costs of the rows left is its lower bound, each end state has an
incumbent (cost, audit), and a table per (rows used, state) holds the least (cost, audit) that reached it: what does not
come below it is dropped. Between blocks only the best prefix of each of four states remains, with the running digest
of its repaired text, so a conversation of any length needs the memory of a block and its audits. A prefix never ties
with its own extension (insertions cost), so comparing (cost, audit) of prefixes is exact.

Defined results: a null role or text counts as one space, in the crc32 key a null conv_id or turn too. Null conv_ids
are one conversation. Null turns come first; rows of one turn go by role, then text. An empty role has an empty initial,
which no order allows. Repeated rows are duplicates. A conversation without rows after damage has zeros, an empty audit
and the digest of the empty string. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role initial; a missing entry is not allowed. Conversations may end in START or ASSISTANT.
NEXT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
ENDS = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
#: The only role that may be set or inserted in a state, and the state after it.
SET = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
SPACES = " \t\n\x0b\x0c\r"

Best = tuple[int, str]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32 of `conv_id:turn`; dropped rows stay, marked and without text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), hit.alias("hit"))
    changed = F.when(F.col("hit") == 0, None).when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 0, None).when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"), (F.col("hit") == 0).alias("dropped"), copies.alias("copy"),
    ).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds `fault`: the first of blank, duplicate (by role and text seen earlier), truncated; else null.

    The rows are dealt by conversation; the window over equal rows of one conversation needs no other exchange.
    """
    bare = F.expr("rtrim('" + SPACES.encode("unicode_escape").decode().replace("\\x0b", "\\u000B").replace("\\x0c", "\\u000C") + "', text)")
    same = Window.partitionBy("conv_id", "dropped", "role", "text_digest").orderBy(F.col("turn").asc_nulls_first())
    last = F.substring("bare", -1, 1)
    fault = (
        F.when(F.col("dropped"), None).when(F.col("bare") == "", "blank").when(F.col("seen") > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    )
    dealt = rows.withColumn("text_digest", F.sha2("text", 256)).repartition("conv_id")
    return dealt.withColumn("seen", F.row_number().over(same)).withColumn("bare", bare).withColumn("fault", fault).drop("bare", "text_digest")


# Search


def _row_cost(initial: str, fault: str | None) -> int:
    """The least that a row can cost in any state."""
    if fault in ("blank", "duplicate"):
        return DELETE
    extra = TRUNCATED if fault == "truncated" else 0
    return min(DELETE, (KEEP if initial in ("s", "u", "a") else REROLE) + extra)


def search_block(rows: list[tuple[str, str | None]], entries: dict[int, Best], last: bool) -> dict[int, tuple[Best, int, str]]:
    """Best (cost, audit), entry state and own audit for each state after the rows (initial, fault).

    In the last block only end states count. `entries` are the best prefixes of the states before the block.
    """
    n = len(rows)
    bound = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        bound[k] = bound[k + 1] + _row_cost(*rows[k])
    goals = ENDS if last else (START, SYSTEM, USER, ASSISTANT)
    incumbent: dict[int, tuple[Best, int, str]] = {}
    table: dict[tuple[int, int], Best] = {}
    stack = [(0, state, cost, audit, state, "") for state, (cost, audit) in sorted(entries.items(), key=lambda e: e[1], reverse=True)]
    while stack:
        at, state, cost, prefix, entry, audit = stack.pop()
        reached = (cost, prefix + audit)
        best = table.get((at, state))
        if best is not None and best <= reached:
            continue
        limit = _limit(incumbent, goals, last)
        if limit is not None and cost + bound[at] > limit:
            continue
        table[at, state] = reached
        if at == n and state in goals and (state not in incumbent or reached < incumbent[state][0]):
            incumbent[state] = (reached, entry, audit)
        branches = [(INSERT, "I", at, SET[state][1])]
        if at < n:
            initial, fault = rows[at]
            extra = TRUNCATED if fault == "truncated" else 0
            branches.append((DELETE, "D", at + 1, state))
            if fault in (None, "truncated"):
                branches.append((REROLE + extra, "R", at + 1, SET[state][1]))
                if (state, initial) in NEXT:
                    branches.append((KEEP + extra, "K", at + 1, NEXT[state, initial]))
        # The cheapest branch is taken first, so that the first incumbent is a good one.
        for price, letter, then, after in sorted(branches, key=lambda b: (b[0] + bound[b[2]], b[1]), reverse=True):
            stack.append((then, after, cost + price, prefix, entry, audit + letter))
    return incumbent


def _limit(incumbent: dict[int, tuple[Best, int, str]], goals: tuple[int, ...], last: bool) -> int | None:
    """A cost above which no node can improve an incumbent."""
    if last:
        return min((b[0][0] for b in incumbent.values()), default=None)
    return max(b[0][0] for b in incumbent.values()) if len(incumbent) == len(goals) else None


class Repair:
    """One conversation as a stream of rows in order."""

    def __init__(self) -> None:
        self.block: list[tuple[str, str, str | None]] = []
        self.best: dict[int, Best] = {START: (0, "")}
        self.digests = {START: hashlib.sha256()}
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = self.rows = 0
        self.before = self.first = self.turn = None

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if len(self.block) == BLOCK:
            self._close(False)
        initial = role[:1]
        if self.rows and self.before + initial not in LEGAL_PAIRS:
            self.illegal += 1
        if turn is not None and (self.turn is None or turn != self.turn):
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if fault:
            self.counts[fault] += 1
        self.before, self.rows = initial, self.rows + 1
        self.block.append((role, text, fault))

    def _close(self, last: bool) -> None:
        found = search_block([(r[:1], f) for r, _, f in self.block], self.best, last)
        digests = {}
        for state, (_, entry, audit) in found.items():
            digest, now, rows = self.digests[entry].copy(), entry, iter(self.block)
            for letter in audit:
                role, text, _ = ("", "", None) if letter == "I" else next(rows)
                if letter == "D":
                    continue
                if letter == "I":
                    role, after = SET[now]
                elif letter == "R":
                    role, after = SET[now]
                else:
                    after = NEXT[now, role[:1]]
                digest.update((("" if now == START else "\n") + role + ":" + text).encode())
                now = after
            digests[state] = digest
        self.best, self.digests, self.block = {s: b[0] for s, b in found.items()}, digests, []

    def result(self) -> tuple:
        self._close(True)
        (cost, audit), state = min((b, s) for s, b in self.best.items())
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        return (gaps, *self.counts.values(), self.illegal, cost, audit, self.digests[state].hexdigest())


COLUMNS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.strip().split()[0] for c in COLUMNS.split(",")]
_SCHEMA = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in _NAMES])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_id, now, done = None, None, []
    for batch in batches:
        for conv, turn, role, text, dropped, fault in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if now is None or conv != open_id:
                if now is not None:
                    done.append((open_id, *now.result()))
                open_id, now = conv, Repair()
            if not dropped:
                now.add(turn, role, text, fault)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
            done = []
    if now is not None:
        last = [(open_id, *now.result())]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*last, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def repaired(rows: DataFrame) -> DataFrame:
    """Faults, least cost, its edits and the digest of the repaired text of every conversation."""
    order: list[Column] = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("seen")]
    ordered = with_faults(rows).sortWithinPartitions(F.col("conv_id"), *order)
    slim = ordered.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", "dropped", "fault")
    return slim.mapInArrow(_repaired, COLUMNS)
