"""URL filter: rules first, then gradient-boosted trees on lexical features.

Labelled URLs are those that a rule decides. The trees see lengths, depth, digit ratio, entropy, parameter
counts and statistics of the host's suffix (frequency among all URLs, block rate among the labelled ones),
the statistics being counted exactly over all URLs and joined to them. Training takes at most `sample`
labelled URLs, drawn by hash; every URL is judged.

Defined results: a null url or one without "://" has empty host and path, fits no rule and is judged by the trees;
with no labelled URL, or labels of one kind only, the trees always say that kind (allow if none); repeated rows
are judged alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import stored

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Tasks that URLs of one suffix are dealt to.
SALTS = 32
SAMPLE = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1)
    return rows.select("page_id", "url", host.alias("host"), path.alias("path"))


def with_rule(rows: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds rule and rule_verdict: the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rows.withColumns({"rule": rule, "rule_verdict": verdict})


def with_suffixes(rows: DataFrame) -> DataFrame:
    """Adds the last label and the last two labels of the host."""
    return rows.withColumns({f"suffix_{d}": F.substring_index("host", ".", -d) for d in (1, 2)})


def suffix_statistics(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact counts of URLs, labelled and blocked ones by suffix of one and of two labels; they combine before the shuffle."""
    two = stored(
        rows.groupBy("suffix_1", "suffix_2").agg(
            F.count("*").alias("n_2"), F.count("rule_verdict").alias("labelled_2"), F.count_if(F.col("rule_verdict") == "block").alias("blocked_2")
        ),
        "suffixes",
    )
    one = two.groupBy("suffix_1").agg(*[F.sum(f"{c}_2").alias(f"{c}_1") for c in ("n", "labelled", "blocked")])
    return one, two.drop("suffix_1")


def with_statistics(rows: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """Adds the counts of both suffixes to every URL; a suffix with a third of all URLs is dealt to many tasks."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    for key, counts in (("suffix_2", two), ("suffix_1", one)):
        rows = rows.join(counts.withColumn("salt", every), [key, "salt"])
    return rows.drop("salt")


FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "entropy", "parameters",
    "fragment", "hyphens", "longest_segment", "frequency_1", "block_rate_1", "frequency_2", "block_rate_2",
)


def features(batch: pa.RecordBatch, totals: tuple[int, int, int]) -> np.ndarray:
    """One row of FEATURES for each URL; `totals` are the counts of all URLs, labelled and blocked ones."""
    urls = [u or "" for u in batch["url"].to_pylist()]
    hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
    out = np.zeros((len(urls), len(FEATURES)))
    total = max(1, totals[0])
    prior = (totals[2] + 1) / (totals[1] + 2)
    for k, (url, host, path) in enumerate(zip(urls, hosts, paths, strict=True)):
        counts = np.unique(np.frombuffer(url.encode(), np.uint8), return_counts=True)[1]
        share = counts / max(1, counts.sum())
        query = url.partition("?")[2].partition("#")[0]
        segments = path.split("/")
        out[k, :12] = (
            len(url), len(host), len(path), len(query), max(0, len(segments) - 1), host.count(".") + 1 if host else 0,
            sum(c.isdigit() for c in url) / max(1, len(url)), -(share * np.log2(share)).sum() if len(share) else 0,
            query.count("=") , "#" in url, url.count("-"), max(map(len, segments)),
        )
    for d in range(2):
        n, labelled, blocked = (batch[f"{c}_{d + 1}"].to_numpy() for c in ("n", "labelled", "blocked"))
        out[:, 12 + 2 * d] = np.log1p(n) - np.log1p(total)
        out[:, 13 + 2 * d] = (blocked + prior * 4) / (labelled + 4)
    return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, least: float = 5.0) -> dict:
    """Trees for log loss on quantile bins. Each tree is a full binary tree of (feature, threshold) and leaf values."""
    if not len(y) or y.min() == y.max():
        return {"base": 0.0 if not len(y) else (8.0 if y[0] else -8.0), "trees": []}
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw, out = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        splits = []
        for level in range(depth):
            nodes = 1 << level
            best = [(0.0, 0, np.inf)] * nodes
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                at = node * width + binned[:, f]
                gs = np.bincount(at, g, nodes * width).reshape(nodes, width).cumsum(1)
                hs = np.bincount(at, h, nodes * width).reshape(nodes, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gl, hl = gs[:, :-1], hs[:, :-1]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < least / 20) | (ht - hl < least / 20)] = 0
                for n in range(nodes):
                    b = int(gain[n].argmax())
                    if gain[n, b] > best[n][0] + 1e-9:
                        best[n] = (float(gain[n, b]), f, float(e[b]))
            splits.append([(f, t) for _, f, t in best])
            f = np.array([s[0] for s in splits[-1]])[node]
            t = np.array([s[1] for s in splits[-1]])[node]
            node = node * 2 + (x[np.arange(len(y)), f] > t)
        leaf = -rate * np.bincount(node, g, 1 << depth) / (np.bincount(node, h, 1 << depth) + 1)
        raw += leaf[node]
        out.append((splits, leaf))
    return {"base": base, "trees": out}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    raw = np.full(len(x), model["base"])
    rows = np.arange(len(x))
    for splits, leaf in model["trees"]:
        node = np.zeros(len(x), np.int64)
        for level in splits:
            f, t = np.array([s[0] for s in level])[node], np.array([s[1] for s in level])[node]
            node = node * 2 + (x[rows, f] > t)
        raw += leaf[node]
    return 1 / (1 + np.exp(-raw))


def training_sample(rows: DataFrame, labelled: int, sample: int) -> DataFrame:
    """At most `sample` labelled URLs, those of the lowest hashes, with y = 1 for blocked ones.

    Hashes above a bound that leaves about twice the sample are cut first, so that tasks do not hand on a sample each.
    """
    known = rows.where("rule_verdict is not null").select(
        "page_id", "url", "host", "path", "suffix_1", "suffix_2", (F.col("rule_verdict") == "block").cast("int").alias("y"),
        F.xxhash64("url", "page_id").alias("h"),
    )
    if labelled > 4 * sample:
        bound = int((2 * sample / labelled - 0.5) * 2**64)
        known = known.where(F.col("h") <= bound)
    return known.orderBy("h", "url", "page_id").limit(sample).drop("h")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score of every page."""
    spark = pages.sparkSession
    plain = with_suffixes(with_rule(split_url(pages), rules))
    one, two = suffix_statistics(plain)
    totals = tuple(one.agg(*[F.coalesce(F.sum(f"{c}_1"), F.lit(0)) for c in ("n", "labelled", "blocked")]).first())
    rows = with_statistics(plain, one, two)
    got = training_sample(plain, totals[1], sample)
    got = with_statistics(got, one, two).orderBy("url", "page_id").toArrow()  # an order of its own, so that reruns agree
    batch = got.combine_chunks().to_batches()
    x = np.concatenate([features(b, totals) for b in batch]) if batch else np.zeros((0, len(FEATURES)))
    model = boost(x, got["y"].to_numpy().astype(float) if len(got) else np.zeros(0))
    shared = spark.sparkContext.broadcast((model, totals))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, totals = shared.value
        for b in batches:
            p = predict(model, features(b, totals))
            by_rule = b["rule_verdict"].to_pylist()
            verdict = [r or ("block" if s >= threshold else "allow") for r, s in zip(by_rule, p, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["host"], b["path"], b["rule"], pa.array(verdict, pa.string()), pa.array(p)],
                ["page_id", "host", "path", "rule", "verdict", "block_score"],
            )

    return rows.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, block_score double")
