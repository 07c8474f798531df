"""Exact Shapley attribution of boosted trees against one baseline.

A leaf gives its value where all conditions of its path hold. A feature outside
the coalition takes its baseline value, so of a leaf only two sets matter for a
row: the features whose conditions the row meets and the baseline does not
(``u`` of them), and those that the baseline meets and the row does not (``v``).
If some condition is met by neither, the leaf gives nothing. Else the leaf is
reached exactly by the coalitions that hold the first set and none of the
second, and a feature's Shapley value of it is

    value * (u - 1)! v! / (u + v)!     for a feature of the first set,
  - value * u! (v - 1)! / (u + v)!     for one of the second,

added up over all leaves. A path has at most as many features as the tree is
deep, so a row costs one look at each leaf (trees x 2^depth at most, a bounded
table that is one constant of the expression), with no sampling and no shuffle.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telco_mart.session import scratch_path


@dataclass(frozen=True)
class Leaf:
    """A value and, by feature, the interval (low, high] that its path allows."""

    value: float
    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: list[float]) -> list[bool]:
        return [low < x[f] <= high for f, low, high in self.bounds]


def leaves_of(nodes: dict[int, tuple], weight: float = 1.0) -> list[Leaf]:
    """Leaves of a tree of nodes: number -> (value,) or (feature, threshold, left,
    right), values up to the threshold going left; node 0 is the root."""
    out, open_ = [], [(0, {})]
    while open_:
        k, bounds = open_.pop()
        node = nodes[k]
        if len(node) == 1:
            out.append(Leaf(weight * node[0], tuple((f, *b) for f, b in sorted(bounds.items()))))
            continue
        feature, threshold, left, right = node
        low, high = bounds.get(feature, (-math.inf, math.inf))
        open_.append((left, {**bounds, feature: (low, min(high, threshold))}))
        open_.append((right, {**bounds, feature: (max(low, threshold), high)}))
    return [leaf for leaf in out if all(low < high for _, low, high in leaf.bounds)]


def model_leaves(spark: SparkSession, model) -> list[Leaf]:
    """Leaves of a fitted boosted-tree model in log-odds, from its saved node
    table (as many rows as the model has nodes)."""
    path = scratch_path(spark, f"tree_nodes_{model.uid}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).collect()
    trees: dict[int, dict] = {}
    for r in nodes:
        trees.setdefault(r.treeID, {})[r.id] = (r.prediction,) if r.leftChild < 0 else (r.feature, r.threshold, r.leftChild, r.rightChild)
    return [leaf for t, tree in sorted(trees.items()) for leaf in leaves_of(tree, 2.0 * model.treeWeights[t])]  # log-odds are twice the margin


def value_at(leaves: list[Leaf], x: list[float]) -> float:
    """The trees' value of one point."""
    return sum(leaf.value for leaf in leaves if all(leaf.holds(x)))


def _weights(most: int) -> list[list[float]]:
    """w[a][b] = a! b! / (a + b + 1)!"""
    f = math.factorial
    return [[f(a) * f(b) / f(a + b + 1) for b in range(most)] for a in range(most)]


def shapley(rows: DataFrame, leaves: list[Leaf], baseline: list[float], x: Column, name: str = "phi") -> DataFrame:
    """``rows`` with ``name``, an array of the Shapley value of each feature of
    the array ``x``: they add up to f(x) - f(baseline)."""
    features = len(baseline)
    # features that row and baseline cannot tell apart drop out here if the leaf holds at all
    conditions = lambda leaf: [dict(f=f, low=float(low), high=float(high), base=bool(b)) for (f, low, high), b in zip(leaf.bounds, leaf.holds(baseline))]
    kind = "array<struct<value:double,bounds:array<struct<f:int,low:double,high:double,base:boolean>>>>"
    held = [dict(value=float(leaf.value), bounds=conditions(leaf)) for leaf in leaves if leaf.bounds]
    table = F.from_json(F.lit(json.dumps(held)), kind)  # a constant: parsed once, and the plan has no more nodes with more leaves
    most = max([len(leaf.bounds) for leaf in leaves], default=0) + 1
    weight = F.array(*(F.array(*(F.lit(w) for w in row)) for row in _weights(most)))

    def met(c: Column) -> Column:
        value = F.get("__x", c["f"])
        return (value > c["low"]) & (value <= c["high"])

    def told_apart(leaf: Column) -> Column:
        """(value, conditions that exactly one of row and baseline meets)"""
        apart = F.filter(leaf["bounds"], lambda c: met(c) != c["base"])
        return F.struct(leaf["value"].alias("value"), F.transform(apart, lambda c: F.struct(c["f"].alias("f"), c["base"].alias("base"))).alias("apart"))

    def given(leaf: Column) -> Column:
        v = F.size(F.filter(leaf["apart"], lambda c: c["base"]))
        u = F.size(leaf["apart"]) - v
        with_ = leaf["value"] * F.get(F.get(weight, u - 1), v)
        without = -leaf["value"] * F.get(F.get(weight, u), v - 1)
        return F.transform(leaf["apart"], lambda c: F.struct(c["f"].alias("f"), F.when(c["base"], without).otherwise(with_).alias("value")))

    reached = F.filter(table, lambda leaf: F.forall(leaf["bounds"], lambda c: met(c) | c["base"]))
    parts = F.flatten(F.transform(F.transform(reached, told_apart), given))
    total = lambda held, f: F.aggregate(F.filter(held, lambda p: p["f"] == f), F.lit(0.0), lambda s, p: s + p["value"])
    numbers = F.sequence(F.lit(0), F.lit(features - 1))
    phi = F.transform(F.array("__parts"), lambda held: F.transform(numbers, lambda f: total(held, f)))[0]  # the parts once a row, not once a feature
    return rows.withColumn("__x", x.cast("array<double>")).withColumn("__parts", parts).withColumn(name, phi).drop("__x", "__parts")


def mean_absolute(attributed: DataFrame, names: list[str], phi: str = "phi") -> DataFrame:
    """(feature, mean_abs_shap), largest first."""
    means = attributed.agg(*(F.avg(F.abs(F.get(phi, F.lit(i)))).alias(n) for i, n in enumerate(names)))
    return means.unpivot([], list(names), "feature", "mean_abs_shap").orderBy(F.col("mean_abs_shap").desc(), "feature")
