"""URL filters: fixed rules first, gradient-boosted trees on lexical features where no rule fits.

Features are small whole numbers (bins). Trees are grown level by level: one aggregate over (leaf, feature, bin) gives the sums of
gradients and of second derivatives, of which the driver gets at most leaves x features x bins rows and picks the splits. Gradients are
whole multiples of 2^-20, so their sums and the model don't depend on how rows are spread. URLs of equal features are one row
with counts. The trees become one expression; learning and scoring are DataFrame functions throughout.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.session import written

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TREES, DEPTH, RATE, RIDGE = 12, 3, 0.3, 1.0
# Bins 0 to 63 of each feature; a leaf needs this much second derivative (about four times as many rows).
BINS, LEAF_WEIGHT = 64, 1.0
_UNIT = 1 << 20
# Weight of the overall share of blocked URLs in that of a suffix.
_SMOOTH = 20
FEATURES = (
    "length", "host_length", "path_length", "query_length", "host_depth", "path_depth", "digit_share", "host_digit_share", "hyphens",
    "escapes", "parameters", "entropy", "host_entropy", "is_secure", "has_fragment", "suffix_count", "suffix_blocked",
)


class Split(NamedTuple):
    feature: int
    bin: int  # up to here to the left


class Tree(NamedTuple):
    splits: dict[int, Split]  # by node; the root is 1, the children of n are 2n and 2n + 1
    leaves: dict[int, float]


class Model(NamedTuple):
    base: float
    share: float  # of blocked among the labelled
    trees: list[Tree]
    suffixes: DataFrame  # (suffix, suffix_count, suffix_blocked)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    host = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: the host or a domain above it, and the beginning of the path."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found["rule"], found["verdict"]


def _entropy(text: Column) -> Column:
    """Bits a character, from the runs of the sorted characters."""
    chars = F.array_sort(F.split(text, ""))
    size = F.size(chars).cast("double")

    def weighed(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(0.0)

    zero = F.struct(F.lit("").alias("char"), F.lit(0.0).alias("n"), F.lit(0.0).alias("sum"))

    def step(state: Column, char: Column) -> Column:
        same = state["char"] == char
        return F.struct(
            char.alias("char"), F.when(same, state["n"] + 1.0).otherwise(1.0).alias("n"),
            F.when(same, state["sum"]).otherwise(state["sum"] + weighed(state["n"])).alias("sum"),
        )

    total = F.aggregate(chars, zero, step, lambda s: s["sum"] + weighed(s["n"]))
    return F.when(F.length(text) > 0, F.log2(size) - total / size).otherwise(0.0)


def _bin(value: Column) -> Column:
    return F.least(F.greatest(F.floor(value), F.lit(0)), F.lit(BINS - 1)).cast("int")


def _logs(n: Column, steps: int) -> Column:
    return _bin(F.log2(n.cast("double") + 1) * steps)


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _share(part: Column, text: Column) -> Column:
    return _bin(F.when(F.length(text) > 0, part * (BINS - 1) / F.length(text)).otherwise(0.0))


def with_parts(rows: DataFrame) -> DataFrame:
    """`rows` with host, path and suffix: the last label of the host."""
    return rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn(
        "suffix", F.element_at(F.split("host", r"\."), -1)
    )


def with_bins(parts: DataFrame, suffixes: DataFrame, share: float) -> DataFrame:
    """Adds `bins`, the features in order. A suffix that no labelled URL has counts 0 and has the overall share."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = {
        "length": _logs(F.length(url), 6),
        "host_length": _logs(F.length(host), 6),
        "path_length": _logs(F.length(path), 6),
        "query_length": _logs(F.length(query), 6),
        "host_depth": _bin(_count(host, r"\.")),
        "path_depth": _bin(F.size(F.split(path, "/+")) - 1),
        "digit_share": _share(_count(url, "[0-9]"), url),
        "host_digit_share": _share(_count(host, "[0-9]"), host),
        "hyphens": _bin(_count(host, "-")),
        "escapes": _bin(_count(url, "[%@~]")),
        "parameters": _bin(_count(query, "=")),
        "entropy": _bin(_entropy(url) * 8),
        "host_entropy": _bin(_entropy(host) * 8),
        "is_secure": F.startswith(url, F.lit("https://")).cast("int"),
        "has_fragment": (F.instr(url, "#") > 0).cast("int"),
        "suffix_count": _logs(F.coalesce("suffix_count", F.lit(0)), 2),
        "suffix_blocked": _bin(F.coalesce("suffix_blocked", F.lit(float(share))) * (BINS - 1)),
    }
    known = parts.join(suffixes, "suffix", "left")
    return known.withColumn("bins", F.array(*[values[f] for f in FEATURES])).drop("suffix_count", "suffix_blocked")


def _walked(tree: Tree, ends: Callable[[int], str]) -> str:
    """SQL over the column `bins` that walks the tree; `ends` says what a leaf is worth."""
    def at(node: int) -> str:
        split = tree.splits.get(node)
        if split is None:
            return ends(node)
        return f"CASE WHEN bins[{split.feature}] <= {split.bin} THEN {at(2 * node)} ELSE {at(2 * node + 1)} END"

    return at(1)


def _value(tree: Tree) -> str:
    return _walked(tree, lambda node: f"{tree.leaves[node]!r}D")


def chance(margin: Column) -> Column:
    return F.lit(1.0) / (F.exp(-margin) + 1.0)


def margin(model: Model) -> Column:
    return F.expr(" + ".join([f"{model.base!r}D", *map(_value, model.trees)]))


def best_splits(sums: dict[int, dict[tuple[int, int], tuple[int, int]]]) -> dict[int, Split]:
    """Of each leaf the split with the largest gain above zero; ties to the first feature and bin. Sums are (gradient, second)
    by (feature, bin), in units."""
    out = {}
    for node, cells in sums.items():
        features: dict[int, list[tuple[int, int, int]]] = {}
        for (feature, b), (g, h) in cells.items():
            features.setdefault(feature, []).append((b, g, h))
        best: tuple[float, int, int] | None = None
        for feature, found in sorted(features.items()):
            found.sort()
            g_all, h_all = sum(g for _, g, _ in found), sum(h for _, _, h in found)
            g_left = h_left = 0
            for b, g, h in found[:-1]:
                g_left, h_left = g_left + g, h_left + h
                sides = [(g_left / _UNIT, h_left / _UNIT), ((g_all - g_left) / _UNIT, (h_all - h_left) / _UNIT)]
                if min(h for _, h in sides) < LEAF_WEIGHT:
                    continue
                whole = (g_all / _UNIT) ** 2 / (h_all / _UNIT + RIDGE)
                gain = sum(g * g / (h + RIDGE) for g, h in sides) - whole
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, feature, b)
        if best:
            out[node] = Split(best[1], best[2])
    return out


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Model:
    """A model of `labelled` (url, is_blocked boolean); rows with a NULL label take no part, repeated rows count as often.

    Without rows of both labels there are no trees and every URL gets the one label, none at all meaning allowed.
    """
    rows = with_parts(labelled.where("is_blocked is not null").select("url", F.col("is_blocked").cast("int").alias("y")))
    counts = F.sum("y").alias("blocked"), F.count("*").alias("n")
    by_suffix = written(rows.groupBy("suffix").agg(*counts), "suffixes")
    blocked, n = by_suffix.agg(F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    share = (blocked + 0.5) / (n + 1) if n else 0.0
    suffixes = by_suffix.select(
        "suffix", F.col("n").alias("suffix_count"), ((F.col("blocked") + _SMOOTH * share) / (F.col("n") + _SMOOTH)).alias("suffix_blocked")
    )
    base = math.log(share / (1 - share)) if n else 0.0
    model = Model(base, share, [], suffixes)
    if not 0 < blocked < n:
        return model
    # As many rows as there are different combinations of bins.
    cases = written(with_bins(rows, suffixes, share).groupBy("bins").agg(*counts), "cases")
    for _ in range(trees):
        tree = _grown(_weighed(cases, model), depth)
        if not tree.splits:
            break
        model = model._replace(trees=[*model.trees, tree])
    return model


def _weighed(cases: DataFrame, model: Model) -> DataFrame:
    """(bins, g, h): gradient and second derivative of the rows at the present scores, in whole units."""
    p = chance(margin(model))
    second = F.greatest(F.round(p * (F.lit(1.0) - p) * _UNIT).cast("long"), F.lit(1))
    return cases.select("bins", (F.round(p * _UNIT).cast("long") * F.col("n") - F.col("blocked") * _UNIT).alias("g"), (second * F.col("n")).alias("h"))


def _grown(weighed: DataFrame, depth: int) -> Tree:
    tree = Tree({}, {})
    open_leaves = [1]
    for level in range(depth):
        placed = weighed.withColumn("node", F.expr(_walked(tree, str))).where(F.col("node").isin(open_leaves))
        cells = placed.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin")).groupBy("node", "feature", "bin").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")
        )
        sums: dict[int, dict] = {}
        for r in cells.collect():
            sums.setdefault(r["node"], {})[r["feature"], r["bin"]] = (r["g"], r["h"])
        splits = best_splits(sums)
        last = level == depth - 1
        for node, found in sums.items():
            if node not in splits:
                tree.leaves[node] = _worth(found, 0, 0, BINS)
            elif last:
                feature, at = splits[node]
                tree.leaves[2 * node] = _worth(found, feature, 0, at)
                tree.leaves[2 * node + 1] = _worth(found, feature, at + 1, BINS)
        tree.splits.update(splits)
        open_leaves = [child for node in splits for child in (2 * node, 2 * node + 1)]
        if not open_leaves:
            break
    return tree


def _worth(cells: dict[tuple[int, int], tuple[int, int]], feature: int, low: int, high: int) -> float:
    """What a leaf of the rows with bins low to high adds to the score."""
    g, h = (sum(v[i] for (f, b), v in cells.items() if f == feature and low <= b <= high) for i in (0, 1))
    return -RATE * (g / _UNIT) / (h / _UNIT + RIDGE)


def judged(pages: DataFrame, model: Model, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): one row per input row, in no order.

    `verdict` is that of the longest rule, whose text is `rule`; where none fits, `score` (the trees' probability of a block) decides:
    block above 0.5. NULL urls and those without `://` have an empty host and path, so the trees judge them. URLs are read
    whole; rows with the same page_id stay separate rows. Other columns are not read; an empty table gives an empty one.
    """
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = with_parts(pages.select(F.col("page_id"), F.col("url")))
    binned = with_bins(parts, model.suffixes, model.share)
    return binned.withColumn("score", chance(margin(model))).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score",
    )


def labelled_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(url, is_blocked) of the pages that a rule judges: the labelled URLs where there are no others."""
    _, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return with_parts(pages.select("url")).select("url", (verdict == "block").alias("is_blocked")).where("is_blocked is not null")
