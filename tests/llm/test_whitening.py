"""Embedding whitening against numpy's eigenvalues and plain integer sums."""

import math
import random

import numpy as np
import pytest

from telco_mart.llm import whitening
from telco_mart.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def brute(vectors):
    """n, exact deviations, eigenvalues from the largest down, whitened rows up to sign."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = np.array([[a - s // n - (s % n) / n for a, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    return n, deviations, e, u, y


def check(rows, vectors, ids, components):
    n, deviations, e, u, y = brute(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(ids) and all(sorted(g) == list(range(1, components + 1)) for g in got.values())
    assert {r.n for r in rows} == {n} and {i: got[i][1].deviation for i in ids} == dict(zip(ids, deviations))
    for k in range(components):
        want = y @ u[:, k] / math.sqrt(e[k])
        have = np.array([got[i][k + 1].whitened for i in ids])
        sign = 1 if want @ have > 0 else -1
        assert np.allclose(have * sign, want, atol=1e-7)
        assert got[ids[0]][k + 1].explained == pytest.approx(e[k] / e.sum(), rel=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and 0 <= rows[0].identity_error < 1e-9


def test_query_matches_numpy_on_the_whole_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = QUERIES["op13_embedding_whitening"](spark, SMALL).collect()
    check(rows, [r.embedding for r in table], [r.vec_id for r in table], 32)


def test_rows_without_a_usable_vector_are_dropped(spark):
    rng = random.Random(3)
    good = [[rng.gauss(0, 1) * (j + 1) for j in range(5)] for _ in range(60)]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)]
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [1.0, float("nan"), 1.0, 1.0, 1.0], [float("inf")] + [0.0] * 4, [1.0, 2.0], [3e30] * 5]
    df = spark.createDataFrame(rows + [(900 + i, v, 2, None) for i, v in enumerate(bad)], SCHEMA).repartition(7)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    single = [[np.float32(c).item() for c in v] for v in good]
    check(out.collect(), single, list(range(60)), 5)


def test_dependent_dimensions_repeats_and_single_rows(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 5.0, float(i % 3)], 1, "x") for i in range(42)] * 2
    out = whitening.whiten(spark.createDataFrame(rows + [(None, [0.0, 0.0, 5.0, 0.0], 1, "x")], SCHEMA)).collect()
    assert {r.component for r in out} == {1, 2} and {r.n for r in out} == {85} and out[0].identity_error < 1e-9
    assert sum(r.vec_id is None for r in out) == 2 and len(out) == 170
    assert sum({r.component: r.explained for r in out}.values()) == pytest.approx(1)
    for few in ([], [(1, [1.0, 2.0], 1, "x")], [(1, [1.0, 2.0], 1, "x")] * 3, [(1, None, 1, "x")]):
        assert whitening.whiten(spark.createDataFrame(few, SCHEMA)).collect() == []


def test_large_entries_stay_exact(spark):
    big = [[1e9, -3.0], [2e9, 7.5], [-1e9, 0.25], [5e8, 1.0]]
    out = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(big)], "vec_id long, embedding array<double>"))
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in big]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((4 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert {r.vec_id: r.deviation for r in out.collect()} == {i: w if w < 1 << 63 else None for i, w in enumerate(want)}


@pytest.mark.parametrize("rank", [1, 6, 9])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    a = rng.normal(size=(9, rank)) * 4.0 ** np.arange(rank)
    v = a @ a.T
    factor, order = whitening.pivoted_cholesky(v)
    assert factor.shape == (9, rank) and np.allclose(np.triu(factor, 1), 0) and np.allclose(factor @ factor.T, v[np.ix_(order, order)], rtol=1e-9, atol=1e-9 * v.max())
    turned = whitening.jacobi_columns(factor)
    norms = np.sort((turned**2).sum(0))[::-1]
    assert np.allclose(norms, np.linalg.svd(a, compute_uv=False) ** 2, rtol=1e-6)
    unit = turned / np.sqrt((turned**2).sum(0))
    assert np.allclose(unit.T @ unit, np.eye(rank), atol=1e-12)
