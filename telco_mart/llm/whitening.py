"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

An entry c counts as the integer floor(scale * c) + shift, so sums over the fit
list are exact. Spark reads the vectors three times: for n and the sums, for
the centred scatter, for the covariance of the whitened rows; a task sends one
partial matrix (dimensions x dimensions) however many rows it has, and partial
matrices are added by an aggregate on (i, j). Only these bounded sums reach the
driver, which factors the scatter: with P the pivoting, P'VP = L L', and plane
rotations from the right make the columns of L orthogonal, L J = U E. As then
V = (P U) E^2 (P U)', the squared column norms are the eigenvalues and the
normalised columns the components; V itself is never squared or iterated on.

Inputs: rows whose vector is null or holds a null or non-finite entry, or an
entry whose integer leaves the range of +-2^62, are dropped, and so are vectors
shorter than the longest remaining (the missing entries count as null), among
them empty ones. Repeated rows count each time, a null id passes through.
Components whose eigenvalue is zero to rounding (linearly dependent dimensions,
a single row, equal rows) are left out, as nothing can be divided by zero;
equal eigenvalues keep the order of the columns they came from. ``deviation``
is null where it exceeds a long. Empty tables give empty results. Only the id
and vector columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer form of an entry: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Vectors worked on at once; most sweeps of rotations (a handful are needed).
BLOCK, SWEEPS = 4096, 60


def clean(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, c: array of double) of the rows whose vector can be used."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = lambda c: c.isNotNull() & (F.abs(c) < (1 << 62) / SCALE)  # noqa: E731 - false for NaN and infinities
    return df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("c")).filter(F.col("c").isNotNull() & F.forall("c", fine))


def _integers(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors) of the rows of full length, in blocks."""
    for lo in range(0, batch.num_rows, BLOCK):
        c = batch.column(1).slice(lo, BLOCK)
        rows = np.flatnonzero(np.diff(c.offsets.to_numpy()) == dims)
        if len(rows):
            flat = c.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            yield rows + lo, np.floor(SCALE * flat).astype(np.int64).reshape(-1, dims) + SHIFT


def _added(parts: DataFrame, dims: int) -> np.ndarray:
    """Partial matrices (i, row: array of double) added up, dims x dims."""
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((dims, dims))
    out[cells.column("i").to_numpy(), cells.column("j").to_numpy()] = cells.column("v").to_numpy()
    return out


def _scatter(vectors: DataFrame, dims: int, centre, width: int) -> np.ndarray:
    """Sum of y y' over all rows, y = centre(integer vectors) of ``width`` columns."""

    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            for _, x in _integers(b, dims):
                y = centre(x)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return _added(vectors.mapInArrow(run, "i int, row array<double>"), width)


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L', L lower trapezoidal of as many
    columns as ``v`` has rank; the largest remaining diagonal is next."""
    d = len(v)
    left, order, factor = v.astype(np.float64).copy(), np.arange(d), np.zeros((d, d))
    limit = d * np.finfo(float).eps * max(v.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left.diagonal()[k:]))
        if left[p, p] <= limit:
            return factor[:, :k], order
        for a in (left, factor):
            a[[k, p]] = a[[p, k]]
        left[:, [k, p]] = left[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1:, k] = left[k + 1:, k] / factor[k, k]
        left[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def jacobi_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` times plane rotations that make its columns orthogonal.

    Each sweep visits all pairs in rounds of disjoint pairs (a round robin), so
    that one round rotates half of the columns against the other half at once."""
    g = factor.copy()
    n = g.shape[1]
    seats = np.arange(n + n % 2)
    for _ in range(SWEEPS if n > 1 else 0):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[::-1][:len(seats) // 2]
            real = (p < n) & (q < n)  # the odd column out has no partner
            p, q = np.minimum(p, q)[real], np.maximum(p, q)[real]
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(aa * bb)
            cosine = np.divide(np.abs(ab), size, out=np.zeros_like(ab), where=size > 0)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > 1e-16
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = c * a - c * t * b, c * t * a + c * b
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst < 1e-15:
            break
    return g


@dataclass(frozen=True)
class Whitener:
    """What was fitted: n and sums (Python integers), eigenvalues from the
    largest down, components as columns, and the share of each eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision: the quotient's whole part leaves as an integer."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.float64) / self.n
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact: in 64 bits where the largest
        term shows that they hold it, else in Python integers."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        y = x - whole
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * self.dims < 1 << 63:
            z = self.n * y - np.array([s % self.n for s in self.sums], dtype=np.int64)
            return (z * z).sum(axis=1).tolist()
        rest = [s % self.n for s in self.sums]
        exact = (sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Whitener of (id, c) rows as ``clean`` gives them; None without vectors."""
    dims = vectors.agg(F.max(F.size("c"))).first()[0] or 0
    if not dims:
        return None

    def sums(batches):
        n, total = 0, [0] * dims
        for b in batches:
            for _, x in _integers(b, dims):
                n += len(x)
                halves = ((x >> 31).sum(axis=0).tolist(), (x & ((1 << 31) - 1)).sum(axis=0).tolist())
                total = [t + (h << 31) + low for t, h, low in zip(total, *halves)]
        cells = [pa.array([-1, *range(dims)], pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(cells, names=["i", "v"])

    rows = vectors.mapInArrow(sums, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    by = {r.i: int(r.v) for r in rows}
    whitener = Whitener(by[-1], [by[i] for i in range(dims)], np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    v = _scatter(vectors, dims, whitener.centred, dims) / whitener.n
    factor, order = pivoted_cholesky(v)
    turned = jacobi_columns(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    ranked = np.argsort(-norms, kind="stable")[:components]
    vectors_of = np.empty((dims, len(ranked)))
    vectors_of[order] = turned[:, ranked] / norms[ranked]
    e = norms[ranked] ** 2
    return Whitener(whitener.n, whitener.sums, e, vectors_of, e / np.trace(v) if len(e) else e)


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity, over the fit list: their mean first, then the centred products."""
    k = len(whitener.eigenvalues)

    def sums(batches):
        total = np.zeros(k)
        for b in batches:
            for _, x in _integers(b, whitener.dims):
                total += whitener.whitened(x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total], pa.list_(pa.float64()))], names=["i", "row"])

    mean = _added(vectors.mapInArrow(sums, "i int, row array<double>"), k)[0] / whitener.n
    cov = _scatter(vectors, whitener.dims, lambda x: whitener.whitened(x) - mean, k) / whitener.n
    return float(np.abs(cov - np.eye(k)).max())


def transform(vectors: DataFrame, whitener: Whitener) -> DataFrame:
    """(id, deviation, whitened: array of double) of (id, c) rows."""
    shared = vectors.sparkSession.sparkContext.broadcast(whitener)  # dimensions x components numbers
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches):
        w = shared.value
        for b in batches:
            for rows, x in _integers(b, w.dims):
                out = w.whitened(x)
                ends = pa.array(np.arange(0, out.size + 1, out.shape[1] or 1)[:len(x) + 1].astype(np.int32))
                values = pa.ListArray.from_arrays(ends, pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(w.deviations(x), pa.int64()), values], names=["id", "deviation", "whitened"])

    return vectors.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one
    row per remaining vector and component, numbered from 1."""
    vectors = clean(df, id_col, vector_col)
    whitener = fit(vectors, components)
    if whitener is None or not len(whitener.eigenvalues):
        kind = vectors.schema["id"].dataType.simpleString()
        schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], schema)
    numbers = lambda a: F.array(*(F.lit(float(x)) for x in a))
    share: Column = F.element_at(numbers(whitener.explained), F.col("component"))
    rows = transform(vectors, whitener).select(F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("component", "whitened"))
    return rows.withColumn("component", F.col("component") + 1).select(
        id_col, "component", F.lit(whitener.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(identity_error(vectors, whitener)).alias("identity_error"),
    )
