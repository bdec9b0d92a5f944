"""Decision tree by gain ratio (V20): a distributed search for splits.

A split sends rows with ``feature <= threshold`` to the left. Its gain ratio is the information gain over the split
information, the entropy of the shares of rows that go left and right. Small parts have little split
information, so among the splits of a node only those with at least the mean gain are compared.

Thresholds are quantiles of the training rows. Per level of the tree one aggregate counts rows by (node,
feature, interval between thresholds, class), partial counts first; the driver sees these counts only, at most
nodes x features x ``INTERVALS`` x classes numbers, and picks each node's split from their running sums.
Rows with a null feature lie above all thresholds. Equal splits: the earlier feature, then the lower threshold.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERVALS = 32             # candidate thresholds per feature, plus one


@dataclass
class Node:
    """A leaf, or a split with the nodes of both sides."""

    counts: dict[float, int]
    feature: str | None = None
    threshold: float | None = None
    left: Node | None = None
    right: Node | None = None

    @property
    def label(self) -> float:
        """The most frequent class, the lowest of equal ones."""
        return min(self.counts, key=lambda c: (-self.counts[c], c))


def entropy(counts) -> float:
    total = sum(counts)
    return -sum(n / total * log2(n / total) for n in counts if n)


def thresholds(rows: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """Up to ``INTERVALS - 1`` values of each feature, quantiles of its rows; the highest value splits nothing off."""
    shares = [k / INTERVALS for k in range(1, INTERVALS)]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 100_000).alias(f) for f in features],
                     *[F.max(F.col(f).cast("double")).alias(f"max_{f}") for f in features]).first()
    return {f: sorted({x for x in found[f] or [] if x < found[f"max_{f}"]}) for f in features}


def _interval(feature: str, limits: list[float]) -> Column:
    """Number of thresholds below the value."""
    value = F.col(feature).cast("double")
    above = [F.when(value <= t, F.lit(0)).otherwise(F.lit(1)) for t in limits]
    return sum(above, F.lit(0))


def best_split(by_interval: dict[str, dict[int, dict[float, int]]], limits: dict[str, list[float]], counts: dict[float, int],
               min_instances: int, criterion: str = "gain_ratio") -> tuple[str, float] | None:
    """(feature, threshold) of a node from its counts by feature, interval and class; None where no split gains."""
    total, before, found = sum(counts.values()), entropy(counts.values()), []
    for feature, limit in limits.items():
        left: dict[float, int] = defaultdict(int)
        for k, threshold in enumerate(limit):
            for c, n in by_interval[feature].get(k, {}).items():
                left[c] += n
            n = sum(left.values())
            if n < min_instances or total - n < min_instances or n in (0, total):
                continue
            right = [counts[c] - left[c] for c in counts]
            gain = before - n / total * entropy(left.values()) - (1 - n / total) * entropy(right)
            if gain > 1e-12:
                found.append((gain, entropy([n, total - n]), feature, threshold))
    if not found:
        return None
    mean = sum(g for g, *_ in found) / len(found)
    score = (lambda g, info: g / info) if criterion == "gain_ratio" else (lambda g, info: g)
    worth = [(score(g, info), f, t) for g, info, f, t in found if criterion != "gain_ratio" or g >= mean - 1e-12]
    top = max(w[0] for w in worth)
    return next((f, t) for s, f, t in worth if s >= top - 1e-12)


def grow(rows: DataFrame, features: list[str], label: str, *, max_depth: int = 5, min_instances: int = 1,
         criterion: str = "gain_ratio") -> Node | None:
    """The tree of some training rows, level by level; None without rows."""
    limits = thresholds(rows, features)
    binned = rows.select(F.col(label).cast("double").alias("label"), *features,
                         F.array(*[F.struct(F.lit(f).alias("feature"), _interval(f, limits[f]).alias("interval"))
                                   for f in features]).alias("each"))
    root, open_nodes = None, {}
    for _ in range(max(max_depth, 1)):
        node = F.lit(0) if root is None else _leaf_number(root, open_nodes)
        counted = (binned.withColumn("node", node).where("node IS NOT NULL").select("node", "label", F.inline("each"))
                   .groupBy("node", "feature", "interval", "label").agg(F.count(F.lit(1)).alias("n")).collect())
        by_node: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(dict)))
        for r in counted:
            by_node[r.node][r.feature][r.interval][r.label] = r.n
        if not by_node:
            return root
        if root is None:
            root = Node(_totals(by_node[0][features[0]]))
            open_nodes = {0: root}
        following = []
        for k, leaf in open_nodes.items():
            split = best_split(by_node[k], limits, leaf.counts, min_instances, criterion) if max_depth else None
            if split is None:
                continue
            leaf.feature, leaf.threshold = split
            below = limits[split[0]].index(split[1])
            parts = by_node[k][split[0]]
            leaf.left = Node(_totals({i: c for i, c in parts.items() if i <= below}))
            leaf.right = Node(_totals({i: c for i, c in parts.items() if i > below}))
            following += [child for child in (leaf.left, leaf.right) if len(child.counts) > 1]
        open_nodes = dict(enumerate(following))
        if not open_nodes:
            return root
    return root


def _totals(by_interval: dict[int, dict[float, int]]) -> dict[float, int]:
    out: dict[float, int] = defaultdict(int)
    for counts in by_interval.values():
        for c, n in counts.items():
            out[c] += n
    return dict(out)


def _walk(node: Node, at_leaf) -> Column:
    if node.feature is None:
        return at_leaf(node)
    goes_left = F.coalesce(F.col(node.feature).cast("double") <= node.threshold, F.lit(False))
    return F.when(goes_left, _walk(node.left, at_leaf)).otherwise(_walk(node.right, at_leaf))


def _leaf_number(root: Node, numbered: dict[int, Node]) -> Column:
    of = {id(n): k for k, n in numbered.items()}
    return _walk(root, lambda leaf: F.lit(of.get(id(leaf))).cast("int"))


def predict(root: Node | None) -> Column:
    """The class of a row; null without a tree."""
    return F.lit(None).cast("double") if root is None else _walk(root, lambda leaf: F.lit(float(leaf.label)))
