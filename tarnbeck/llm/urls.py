"""URL filters: rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame functions. The trees are grown level by level: one grouped sum
of gradients by node, feature and bin for each level, over a bounded sample of labelled
URLs, and what is learnt becomes one column expression that judges every URL.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.labelled import first_rows
from tarnbeck.llm.store import stored
from tarnbeck.llm.text import fold
from tarnbeck.sources.tables import table

SAMPLE = 20_000
ROUNDS = 8
DEPTH = 3
BINS = 16
RATE = 0.3
PENALTY = 1.0
#: Parts that labelled URLs fall into; a row's suffix statistics leave out the labels of its own part.
FOLDS = 4
#: Gradients are summed as whole numbers of this unit, so that sums do not depend on their order.
UNIT = 1 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query: fixed values.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(fold(F.regexp_extract(_rest(url), "^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    """The text or verdict of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def _occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part)))) / len(part)


def _entropy(text: Column) -> Column:
    """Bits a character."""
    size = F.length(text)

    def add(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(text, char))) / size
        return total - F.when(char == "", 0.0).otherwise(share * F.log2(share))

    return F.when(size > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add)).otherwise(0.0)


def _last_labels(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


LEXICAL = {
    "length": lambda url, host, path: F.length(url),
    "host_length": lambda url, host, path: F.length(host),
    "path_length": lambda url, host, path: F.length(path),
    "host_labels": lambda url, host, path: _occurrences(host, "."),
    "depth": lambda url, host, path: _occurrences(path, "/"),
    "digit_ratio": lambda url, host, path: F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
    "path_digits": lambda url, host, path: F.length(F.regexp_replace(path, "[^0-9]", "")),
    "hyphens": lambda url, host, path: _occurrences(url, "-"),
    "parameters": lambda url, host, path: F.when(url.contains("?"), 1).otherwise(0) + _occurrences(url, "&"),
    "fragment": lambda url, host, path: F.when(url.contains("#"), 1).otherwise(0),
    "entropy": lambda url, host, path: _entropy(url),
    "host_entropy": lambda url, host, path: _entropy(host),
}
SUFFIXES = {"suffix": 1, "domain": 2}
FEATURES = [*LEXICAL, *(f"{s}_{k}" for s in SUFFIXES for k in ("count", "blocked"))]


def with_features(urls: DataFrame) -> DataFrame:
    """Adds FEATURES as doubles to rows of url (not null), host, path and label (1 blocked, 0 allowed or null)."""
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")
    out = urls
    for name, n in SUFFIXES.items():
        # Counted over all rows; each task sends one row per suffix, so a common one is not hot.
        by_fold = [(F.count(F.when(fold == i, F.col("label"))), F.sum(F.when(fold == i, F.col("label")).otherwise(0))) for i in range(FOLDS)]
        stats = urls.groupBy(_last_labels(F.col("host"), n).alias(name)).agg(
            F.log2(F.count("*") + 1.0).alias(f"{name}_count"),
            F.count("label").alias("_k"),
            F.sum(F.coalesce("label", F.lit(0))).alias("_b"),
            F.array(*(k for k, _ in by_fold)).alias("_k_fold"),
            F.array(*(b for _, b in by_fold)).alias("_b_fold"),
        )
        # A label says nothing about itself, nor about rows of the same URL.
        own_k, own_b = (F.when(F.col("label").isNotNull(), F.get(c, fold)).otherwise(0) for c in ("_k_fold", "_b_fold"))
        blocked = (F.col("_b") - own_b + 1.0) / (F.col("_k") - own_k + 2.0)
        out = out.withColumn(name, _last_labels(F.col("host"), n)).join(stats, name, "left")
        out = out.withColumn(f"{name}_blocked", blocked).drop(name, "_k", "_b", "_k_fold", "_b_fold")
    made = {k: f(F.col("url"), F.col("host"), F.col("path")).cast("double") for k, f in LEXICAL.items()}
    return out.withColumns(made)


# A tree is a leaf value, or (feature, threshold, tree up to it, tree above it).


def _score(tree: tuple | float) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, threshold, low, high = tree
    return F.when(F.col(feature) > threshold, _score(high)).otherwise(_score(low))


def boost(labelled: DataFrame) -> list[tuple | float]:
    """Trees for the log odds of label 1, from rows of FEATURES and label; the first is the prior."""
    good, bad = labelled.agg(F.sum(1 - F.col("label")), F.sum("label")).first()
    prior = math.log(((bad or 0) + 1) / ((good or 0) + 1))
    if not good or not bad:
        return [prior]
    cuts = labelled.agg(
        *(F.percentile(f, F.array(*(F.lit(i / BINS) for i in range(1, BINS)))).alias(f) for f in FEATURES)
    ).first()
    edges = {f: sorted(set(cuts[f])) for f in FEATURES}
    bins = {f: reduce(lambda a, t, f=f: a + (F.col(f) > t).cast("int"), edges[f], F.lit(0)) for f in FEATURES}
    # Bins are worked out once; every level of every tree reads them.
    binned = stored(labelled.select("label", *(bins[f].alias(f) for f in FEATURES)).coalesce(1))
    in_bins: list[tuple | float] = [prior]
    trees: list[tuple | float] = [prior]
    for _ in range(ROUNDS):
        splits: dict[int, tuple[str, int]] = {}
        leaves = {1: 0.0}
        p = 1 / (1 + F.exp(-reduce(lambda a, b: a + b, map(_score, in_bins))))
        rows = binned.withColumn("_p", p)
        for level in range(DEPTH):
            at = {n for n in leaves if n >= 1 << level}
            for node, best in _best_splits(rows, splits, at).items():
                feature, cut, low, high = best
                splits[node] = (feature, cut)
                del leaves[node]
                leaves[2 * node], leaves[2 * node + 1] = low, high
            if not any(n >= 1 << (level + 1) for n in leaves):
                break
        if not splits:
            break
        in_bins.append(_tree(1, splits, leaves))
        trees.append(_tree(1, {n: (f, edges[f][c]) for n, (f, c) in splits.items()}, leaves))
    return trees


def _tree(node: int, splits: dict, leaves: dict) -> tuple | float:
    if node not in splits:
        return RATE * leaves[node]
    return (*splits[node], _tree(2 * node, splits, leaves), _tree(2 * node + 1, splits, leaves))


def _node(splits: dict[int, tuple[str, int]], node: int = 1) -> Column:
    if node not in splits:
        return F.lit(node)
    feature, cut = splits[node]
    return F.when(F.col(feature) > cut, _node(splits, 2 * node + 1)).otherwise(_node(splits, 2 * node))


def _best_splits(rows: DataFrame, splits: dict, nodes: set[int]) -> dict[int, tuple[str, int, float, float]]:
    """For each node the cut with the most gain, and the values of its sides, if any gains."""
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES))
    sums = (
        rows.select(
            _node(splits).alias("node"),
            F.rint((F.col("label") - F.col("_p")) * UNIT).cast("bigint").alias("g"),
            F.rint(F.col("_p") * (1 - F.col("_p")) * UNIT).cast("bigint").alias("h"),
            F.explode(pairs).alias("pair"),
        )
        .groupBy("node", "pair.feature", "pair.bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        .collect()
    )
    by: dict = defaultdict(dict)
    for r in sums:
        if r.node in nodes:
            by[r.node, r.feature][r.bin] = (r.g / UNIT, r.h / UNIT)
    best: dict[int, tuple[str, int, float, float]] = {}
    most: dict[int, float] = {}
    for (node, feature), found in sorted(by.items()):
        g, h = (sum(v[i] for v in found.values()) for i in (0, 1))
        left_g = left_h = 0.0
        for cut in sorted(found)[:-1]:
            left_g, left_h = left_g + found[cut][0], left_h + found[cut][1]
            right_g, right_h = g - left_g, h - left_h
            gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - g**2 / (h + PENALTY)
            if gain > most.get(node, 1e-3):
                most[node] = gain
                best[node] = (feature, cut, left_g / (left_h + PENALTY), right_g / (right_h + PENALTY))
    return best


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page.

    `rules` is a short list. The longest rule that fits gives the verdict. The URLs
    that a rule fits are the labelled ones; at most `sample` of them, the first by a
    hash, teach the trees, which judge the rest: `block` where the score, the
    probability of being blocked, is at least 0.5. A null url is judged as an empty
    one, a long one whole; of rules of one length the last by text is taken. Without
    labelled URLs, or with one label only, the score is that prior. Repeated rows are
    judged each, an empty table gives an empty one. Other columns are not read.
    """
    url = F.coalesce("url", F.lit(""))
    urls = pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    verdict = rule_of(F.col("host"), F.col("path"), rules, "verdict")
    urls = urls.withColumns(
        {"rule": rule_of(F.col("host"), F.col("path"), rules, "text"), "label": (verdict == "block").cast("int")}
    )
    described = with_features(urls)
    labelled = described.where(F.col("label").isNotNull())
    key = F.xxhash64("url", "page_id")
    n_labelled = urls.where(F.col("label").isNotNull()).count()
    trees = boost(stored(first_rows(labelled, key, sample, n_labelled).select("label", *FEATURES)))
    score = 1 / (1 + F.exp(-reduce(lambda a, b: a + b, map(_score, trees))))
    judged = described.withColumn("score", score)
    by_method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    by_rule = F.when(F.col("label") == 1, "block").when(F.col("label") == 0, "allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_method).alias("verdict"), "score")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
