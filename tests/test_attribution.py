"""Exact Shapley values against the definition, coalition by coalition."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from telco_mart.operators.attribution import Leaf, leaves_of, mean_absolute, shapley, value_at


def brute(leaves, x, base):
    n = len(x)
    f = lambda s: value_at(leaves, [x[i] if i in s else base[i] for i in range(n)])
    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        out.append(sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (f({*s, i}) - f(set(s)))
                       for k in range(n) for s in itertools.combinations(rest, k)))
    return out


def random_tree(rng, features, depth):
    nodes, todo = {}, [(0, 0)]
    while todo:
        k, d = todo.pop()
        if d == depth or rng.random() < 0.15:
            nodes[k] = (rng.uniform(-2, 2),)
        else:
            nodes[k] = (rng.randrange(features), rng.randrange(6) + 0.5, 2 * k + 1, 2 * k + 2)
            todo += [(2 * k + 1, d + 1), (2 * k + 2, d + 1)]
    return nodes


@pytest.mark.parametrize("features, depth, trees", [(1, 2, 1), (4, 5, 3), (6, 4, 6)])
def test_values_are_those_of_the_definition(spark, features, depth, trees):
    rng = random.Random(features)
    leaves = [leaf for _ in range(trees) for leaf in leaves_of(random_tree(rng, features, depth), 0.7)]
    base = [float(rng.randrange(7)) for _ in range(features)]
    rows = [(i, [float(rng.randrange(7)) for _ in range(features)]) for i in range(60)] + [(60, base)]
    got = shapley(spark.createDataFrame(rows, "id long, x array<double>"), leaves, base, F.col("x")).collect()
    for r in got:
        assert r.phi == pytest.approx(brute(leaves, r.x, base), abs=1e-9)
        assert sum(r.phi) == pytest.approx(value_at(leaves, r.x) - value_at(leaves, base), abs=1e-9)
    assert got[60].phi == [0.0] * features


def test_leaves_merge_the_conditions_of_a_feature():
    tree = {0: (0, 3.0, 1, 2), 1: (0, 1.0, 3, 4), 2: (0, 2.0, 5, 6), 3: (1.0,), 4: (2.0,), 5: (9.0,), 6: (4.0,)}
    assert sorted(leaves_of(tree, 2.0), key=lambda leaf: leaf.value) == [
        Leaf(2.0, ((0, -math.inf, 1.0),)), Leaf(4.0, ((0, 1.0, 3.0),)), Leaf(8.0, ((0, 3.0, math.inf),))]


def test_trees_without_splits_and_means(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "id long, x array<double>")
    assert [r.phi for r in shapley(df, [Leaf(5.0, ())], [0.0, 0.0], F.col("x")).collect()] == [[0.0, 0.0]] * 2
    stump = [Leaf(1.0, ((1, -math.inf, 3.0),)), Leaf(-1.0, ((1, 3.0, math.inf),))]
    means = mean_absolute(shapley(df, stump, [0.0, 0.0], F.col("x")), ["a", "b"]).collect()
    assert [(r.feature, r.mean_abs_shap) for r in means] == [("b", 1.0), ("a", 0.0)]


def test_the_plan_does_not_grow_with_the_leaves(spark):
    """A hundred trees of thirty-two leaves are one constant, not thousands of expressions in the driver."""
    leaves = [Leaf(float(i % 7), tuple((f, -1.0 + i % 3, math.inf) for f in range(4))) for i in range(3200)]
    rows = spark.createDataFrame([([0.5, 1.5, 2.5, 3.5],)], "x array<double>")
    plans = [shapley(rows, some, [0.0] * 4, F.col("x"))._jdf.queryExecution() for some in (leaves[:2], leaves)]
    calls = [p.analyzed().toString().count("named_struct(") + p.analyzed().toString().count("struct(") for p in plans]
    assert calls[0] == calls[1] < 50
    assert "from_json" not in plans[1].optimizedPlan().toString()  # parsed while planning, not for each row
    got = shapley(rows, leaves, [0.0] * 4, F.col("x")).first().phi
    assert math.isclose(sum(got), value_at(leaves, [0.5, 1.5, 2.5, 3.5]) - value_at(leaves, [0.0] * 4), rel_tol=1e-9)
