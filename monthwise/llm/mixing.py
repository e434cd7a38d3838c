"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Document rates minimise the summed entropy r ln r - r under one token constraint per source and the bound
0 <= r <= `most`. The dual is convex with one multiplier per source, and its optimum tilts exponentially:
r = min(most, exp(multiplier * size / mean size)). A rate depends on source and size alone, so documents are
counted once by (source, size) and every Newton iteration is one grouped sum over these counts, with a
bracket that a step may not leave. Rates become whole copies by carrying the rounding remainder along the
sizes of a source, after which single copies of a few cells settle what is left of the token target.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a source or table
without words gets target 0 and rate 1, so its documents keep one copy and take 0 words; repeated rows are
documents of their own; an empty table gives no rows; further columns are ignored by `mix` and kept by `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import WORD_PATTERN, stored

#: Documents that one ranking group may hold; larger (source, size) cells are split by id hash.
RANK_ROWS = 20_000
_KEYS = ("no_source", "source_key")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """One row per source: its size, its target after capping at `most` times the size, documents and mean size.

    `sizes` holds (no_source, source_key, size, n). Only one row per source passes the two unkeyed windows.
    """
    per = sizes.groupBy(*_KEYS).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    rank = F.row_number().over(Window.orderBy("no_source", "source_key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    every = Window.partitionBy(F.lit(1))
    filled = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), "no_source", "source_key")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    capped, used = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("cap", "weight"))
    level = (F.sum("source_size").over(every) - capped) / (F.sum("weight").over(every) - used)
    per = per.withColumn("level", F.greatest(level, F.lit(0.0)))
    # Sources fill in order of cap per weight; the first that stays below its cap has the highest open level.
    open_ = F.col("level") * F.col("weight") < F.col("cap")
    common = F.max(F.when(open_, F.col("level"))).over(every)
    target = F.when(common.isNull(), F.col("cap")).otherwise(F.least("cap", common * F.col("weight")))
    return per.select(
        *_KEYS, "source_size", "docs", target.alias("target"),
        F.when(F.col("docs") > 0, F.col("source_size") / F.col("docs")).alias("mean_size"),
    )


def _rate(multiplier: Column, x: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(multiplier * x, F.lit(50.0))))


#: A relative distance from the target that sums of doubles may leave behind when the tolerance is not reached.
ROUNDING = 1e-6


def balanced(cells: DataFrame, targets: DataFrame, most: float, tolerance: float = 1e-10, rounds: int = 80) -> DataFrame:
    """Targets with the multiplier of each source, by distributed Newton steps on the dual."""
    free = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * most * (1 - 1e-12))
    state = stored(
        targets.withColumns({
            "free": free, "multiplier": F.lit(0.0), "lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"),
            "off": F.lit(1.0),
        }),
        "multipliers",
    )
    x = F.col("size") / F.col("mean_size")
    for _ in range(rounds):
        rated = cells.join(state.where(F.col("free") & (F.col("off") > tolerance)).select(*_KEYS, "mean_size", "multiplier"), list(_KEYS))
        rate = _rate(F.col("multiplier"), x, most)
        sums = rated.groupBy(*_KEYS).agg(
            F.sum(F.col("n") * x * rate).alias("value"),
            F.sum(F.when(rate < most, F.col("n") * x * x * rate).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("value") - F.col("target") / F.col("mean_size")
        step = F.when(F.col("slope") > 0, -gap / F.col("slope")).otherwise(-F.signum(gap) * 4.0)
        step = F.greatest(F.least(step, F.lit(4.0)), F.lit(-16.0))
        lo = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(gap >= 0, F.col("multiplier")).otherwise(F.col("hi"))
        new = F.col("multiplier") + step
        inside = (lo.isNull() | (new > lo)) & (hi.isNull() | (new < hi))
        new = F.when(inside, new).otherwise((lo + hi) / 2)
        off = F.abs(gap) / (F.col("target") / F.col("mean_size"))
        moved = F.col("value").isNotNull()
        state = stored(
            state.join(sums, list(_KEYS), "left").select(
                *_KEYS, "source_size", "docs", "target", "mean_size", "free",
                F.when(moved & (off > tolerance), new).otherwise(F.col("multiplier")).alias("multiplier"),
                F.when(moved, lo).otherwise(F.col("lo")).alias("lo"),
                F.when(moved, hi).otherwise(F.col("hi")).alias("hi"),
                F.when(moved, off).otherwise(F.col("off")).alias("off"),
            ),
            "multipliers",
        )
        if state.where(F.col("free") & (F.col("off") > tolerance)).isEmpty():
            break
    else:
        if not state.where(F.col("free") & (F.col("off") > ROUNDING)).isEmpty():
            raise RuntimeError(f"sources are further than {ROUNDING} from their targets after {rounds} rounds")
    return state


def cell_copies(cells: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Copies that each (source, size) cell receives in all, and the target of its source."""
    x = F.col("size") / F.col("mean_size")
    rate = (
        F.when(F.col("source_size") == 0, F.lit(1.0))
        .when(F.col("target") <= 0, F.lit(0.0))
        .when(~F.col("free"), F.lit(float(most)))
        .otherwise(_rate(F.col("multiplier"), x, most))
    )
    rated = cells.join(state, list(_KEYS)).withColumn("rate", rate)
    down = Window.partitionBy(*_KEYS).orderBy(F.desc("size"))
    upto = F.sum(F.col("n") * F.col("rate")).over(down)
    whole = F.floor(upto + 0.5) - F.floor(upto - F.col("n") * F.col("rate") + 0.5)
    rated = rated.withColumn("copies", F.least(F.greatest(whole, F.lit(0)), F.col("n") * int(most)).cast("long"))

    # One cell for each power of two of the sizes; from the largest down, each takes what it can of the rest.
    octave = F.floor(F.log2(F.col("size"))).alias("octave")
    chosen = (
        rated.where((F.col("size") > 0) & F.col("free"))
        .groupBy(*_KEYS, octave)
        .agg(F.min(F.struct("size", "n", "copies")).alias("cell"))
        .groupBy(*_KEYS)
        .agg(F.reverse(F.sort_array(F.collect_list("cell"))).alias("ladder"))  # at most 63 entries
    )
    left = rated.where("free").groupBy(*_KEYS).agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("rest")
    )
    settle = chosen.join(left, list(_KEYS)).select(
        *_KEYS,
        F.aggregate(
            "ladder",
            F.struct(F.col("rest").cast("double").alias("rest"), F.array().cast("array<struct<size:bigint,extra:bigint>>").alias("out")),
            lambda a, c: _settled(a, c, most),
            lambda a: a["out"],
        ).alias("out"),
    ).select(*_KEYS, F.inline("out"))
    return (
        rated.join(settle, [*_KEYS, "size"], "left")
        .select(*_KEYS, "size", "n", "rate", "source_size", "target", (F.col("copies") + F.coalesce("extra", F.lit(0))).alias("copies"))
    )


def _settled(state: Column, cell: Column, most: int) -> Column:
    wanted = F.round(state["rest"] / cell["size"]).cast("long")
    extra = F.greatest(F.least(wanted, cell["n"] * int(most) - cell["copies"]), -cell["copies"])
    return F.struct(
        (state["rest"] - extra * cell["size"]).alias("rest"),
        F.concat(state["out"], F.array(F.struct(cell["size"].alias("size"), extra.alias("extra")))).alias("out"),
    )


def with_copies(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Adds size, source_size, target, rate and copies to rows of (row_id, source, size).

    `row_id` decides ties between equal documents, so equal inputs give equal copies. The cells of a source
    with more than RANK_ROWS documents of one size are ranked in parts.
    """
    keyed = rows.withColumn("no_source", F.col("source").isNull()).withColumn("source_key", F.coalesce("source", F.lit("")))
    cells = stored(keyed.groupBy(*_KEYS, "size").agg(F.count("*").alias("n")), "cells")
    state = balanced(cells, source_targets(cells, weights, most), most)
    whole = stored(
        cell_copies(cells, state, most)
        .withColumn("parts", F.ceil(F.col("n") / RANK_ROWS).cast("int"))
        .withColumn("base", F.floor(F.col("copies") / F.col("n")).cast("long"))
        .withColumn("more", F.col("copies") % F.col("n")),
        "copies",
    )
    joined = keyed.join(whole, [*_KEYS, "size"]).withColumn("part", F.pmod(F.xxhash64("row_id"), F.col("parts")).cast("int"))
    big = joined.where("parts > 1").groupBy(*_KEYS, "size", "part").agg(F.count("*").alias("held"), F.first("more").alias("m"), F.first("n").alias("all"))
    upto = F.sum("held").over(Window.partitionBy(*_KEYS, "size").orderBy("part"))
    share = lambda c: F.floor(F.col("m") * c / F.col("all"))
    shares = big.select(*_KEYS, "size", "part", (share(upto) - share(upto - F.col("held"))).alias("part_more"))
    rank = F.row_number().over(Window.partitionBy(*_KEYS, "size", "part").orderBy(F.xxhash64("row_id"), "row_id"))
    ranked = joined.join(shares, [*_KEYS, "size", "part"], "left").withColumn("rank", rank)
    copies = F.col("base") + (F.col("rank") <= F.coalesce("part_more", "more")).cast("long")
    return ranked.withColumn("copies", copies).drop("no_source", "source_key", "n", "parts", "base", "more", "part", "part_more", "rank")


def mix(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate) of every document."""
    sizes = stored(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    out = with_copies(sizes.withColumn("row_id", F.col("doc_id")), weights, most)
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"
    )


def mixed(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The documents of the mix with all their columns: a row for every copy, none for a document at 0.

    Rows that share a doc_id share the copies of the id, which are counted over its rows and dealt evenly.
    """
    columns = documents.columns
    sized = documents.withColumn("_size", word_count(F.col("text")))
    rows = stored(sized.select("doc_id", "source", F.col("_size").alias("size")), "sizes")
    held = with_copies(rows.withColumn("row_id", F.col("doc_id")), weights, most)
    # Equal (doc_id, source, size) rows differ by at most one copy, so their least is what every such row surely has.
    per = held.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n")).agg(
        F.min("copies").alias("_copies")
    )
    kept = sized.join(
        per,
        F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_n")),
    ).where("_copies > 0")
    return kept.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select(*columns)
