"""Secret scan: patterns find candidates, corpus-wide ownership tells copied examples from secrets of one owner.

Candidates are the spans of three fixed patterns (`assign`, `access`, `hex`) and, beside them, long mixed tokens. The
hash of every candidate's value is counted over the whole corpus by distinct repositories and owners: a mixed token
that only one owner holds is a secret of that owner and is added as kind `owned`; one that several owners hold is a
copied example and is not. Pattern spans always stay, with their counts beside them. Only DataFrame functions are used.

Defined results: a null text counts as empty (no spans, digest of the empty string). Null owners and repositories are
one owner and one repository. Repeated rows and repeated or null doc_ids each give one row; equal values of several
rows under one owner count once. Other columns of the input are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import stored

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Of runs of one class the long ones are the maximal ones, so a least length in the pattern drops the same matches.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LEAST_VALUE = 8
#: A token of the method: this many characters with a digit, an upper-case and a lower-case letter.
MIXED = "[A-Za-z0-9+/_-]{24,}"
#: A value held by more owners than this is a copied example.
MOST_OWNERS = 1
#: Positions are summed in blocks of matches, so that a text with very many stays linear.
BLOCK = 256

_AT = "struct<start:int,kind:int,stop:int,digest:binary>"


def _numbered(gaps: str) -> Column:
    """Start of each match from the (gap, length) pairs of a text: sums inside blocks, then over the blocks."""
    inside = (
        "aggregate(block, named_struct('at', base, 'out', cast(array() as array<int>)), (acc, x) -> named_struct("
        "'at', acc.at + x.gap + x.size, 'out', concat(acc.out, array(acc.at + x.gap))), acc -> acc.out)"
    )
    total = "aggregate(block, 0, (acc, x) -> acc + x.gap + x.size)"
    cut = f"transform(sequence(0, (size({gaps}) - 1) div {BLOCK}), b -> slice({gaps}, b * {BLOCK} + 1, {BLOCK}))"
    bases = f"aggregate(transform({cut}, block -> {total}), array(0), (acc, t) -> concat(acc, array(element_at(acc, -1) + t)))"
    return F.expr(
        f"CASE WHEN size({gaps}) = 0 THEN cast(array() as array<int>) ELSE "
        f"flatten(zip_with({cut}, slice({bases}, 1, size({cut})), (block, base) -> {inside})) END"
    )


def _with_matches(frame: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds `name`: array of (start, size, value) of the leftmost non-overlapping matches, in code points."""
    held = F.col("body").rlike(pattern)
    none = F.array().cast("array<string>")
    frame = frame.withColumn("found", F.when(held, F.regexp_extract_all("body", F.lit(pattern), F.lit(0))).otherwise(none))
    frame = frame.withColumn("gaps", F.when(F.size("found") > 0, F.split("body", pattern, -1)).otherwise(none))
    frame = frame.withColumn(
        "gaps",
        F.zip_with(F.slice("gaps", F.lit(1), F.size("found")), "found", lambda g, m: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("size"))),
    )
    frame = frame.withColumn("starts", _numbered("gaps"))
    matches = F.zip_with("starts", "found", lambda s, m: F.struct(s.alias("start"), F.char_length(m).alias("size"), m.alias("value")))
    return frame.withColumn(name, matches).drop("found", "gaps", "starts")


def _span(kind: int, match: Column, value: Column) -> Column:
    return F.struct(
        match["start"].alias("start"), F.lit(kind).alias("kind"), (match["start"] + match["size"]).alias("stop"),
        F.unhex(F.sha2(value, 256)).alias("digest"),
    ).cast(_AT)


def candidates(documents: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per document without its text: doc_id, repository, owner, base spans, mixed tokens outside of them."""
    frame = documents.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("body"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner")
    )
    for name, pattern in (("m_assign", ASSIGN), ("m_access", ACCESS), ("m_hex", HEX), ("m_mixed", MIXED)):
        frame = _with_matches(frame, name, pattern)
    value = lambda m: F.regexp_extract(m["value"], ASSIGN, 2)
    assign = F.transform(F.filter("m_assign", lambda m: F.char_length(value(m)) >= LEAST_VALUE), lambda m: _span(0, m, value(m)))
    access = F.transform("m_access", lambda m: _span(1, m, m["value"]))
    long_hex = F.transform("m_hex", lambda m: _span(2, m, m["value"]))
    looks_made = lambda m: m["value"].rlike("[0-9]") & m["value"].rlike("[A-Z]") & m["value"].rlike("[a-z]")
    mixed = F.transform(F.filter("m_mixed", looks_made), lambda m: _span(3, m, m["value"]))
    frame = frame.select("doc_id", "repository", "owner", F.array_sort(F.concat(assign, access, long_hex)).alias("base"), mixed.alias("mixed"))
    outside = F.filter("mixed", lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    return frame.withColumn("mixed", outside)


def ownership(found: DataFrame) -> DataFrame:
    """digest, owners, repositories, occurrences of every candidate value; grouped in three steps that combine first.

    The first grouping has the owner and the repository in its key, so a value that a third of all documents
    copy is dealt by more than its digest and reaches the last step as one row per owner.
    """
    by_place = found.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_place.groupBy("digest", "owner").agg(F.count("*").alias("places"), F.sum("n").alias("n"))
    return by_owner.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("places").alias("repositories"), F.sum("n").alias("occurrences"))


def _joined(spans: str) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["stop"])), ",")


def scanned(documents: DataFrame, repository: Column, owner: Column, most_owners: int = MOST_OWNERS) -> DataFrame:
    """doc_id, base and all spans, and of the spans' values how many one owner alone holds and how many are copied.

    Texts are read once; what goes on is written to the shared folder, a few numbers a document, so that the row
    numbers that bring a document's spans together again are fixed.
    """
    rows = stored(candidates(documents, repository, owner).withColumn("row", F.monotonically_increasing_id()), "candidates")
    each = rows.select("row", "owner", "repository", F.explode(F.concat("base", "mixed")).alias("span")).select("*", F.col("span.digest").alias("digest"))
    counted = each.select("row", "span", "digest").join(ownership(each), "digest")
    alone = F.col("owners") <= most_owners
    judged = counted.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(alone & (F.col("span.kind") == 3), F.col("span")))).alias("owned"),
        F.count(F.when(alone, 1)).alias("n_owner_specific"), F.count(F.when(~alone, 1)).alias("n_copied"),
        F.max("owners").alias("most_owners"),
    )
    out = rows.join(judged, "row", "left")
    none = F.array().cast(f"array<{_AT}>")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("owned", none))).alias("spans"), zero("n_owner_specific"), zero("n_copied"), zero("most_owners")
    )


def digested(scan: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the pattern spans and all spans as text."""
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return scan.select(
        "doc_id", of(0), of(1), of(2), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        "n_owner_specific", "n_copied", "most_owners",
    )
