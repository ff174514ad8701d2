"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become integers on a grid, equal vectors count once, and the sums over
them are exact. The scatter of the centred vectors is factored as G Gᵀ by Cholesky
with diagonal pivots; plane rotations from the right then make the columns of G
orthogonal. Nothing is squared on the way, so small eigenvalues keep their digits:
the squared norms of the rotated columns are the eigenvalues, and the columns
divided by their norms the components.

Only numbers of the size of a vector or of the scatter reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, sum_vectors


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """G with ``a = G Gᵀ`` for a symmetric positive semidefinite ``a``: columns by falling pivot, as many as its numerical rank.

    In the order of the pivots G is lower triangular; its rows are returned in
    the order of ``a``. What is left of a diagonal entry counts as nothing once
    it is rounding error of that entry, so small dimensions beside large ones
    keep their own digits.
    """
    a = np.array(a, float)
    d = len(a)
    g = np.zeros((d, d))
    left = np.diag(a).copy()
    least = 16 * max(d, 64) * np.finfo(float).eps * left
    done = np.zeros(d, bool)
    for k in range(d):
        open_ = ~done & (left > least)
        if not open_.any():
            return g[:, :k]
        p = int(np.argmax(np.where(open_, left, -np.inf)))
        column = a[:, p] - g[:, :k] @ g[p, :k]
        column[done] = 0.0
        column[p] = left[p]
        g[:, k] = column / np.sqrt(left[p])
        left -= g[:, k] ** 2
        done[p] = True
    return g


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """G times rotations, with columns orthogonal to working precision, the longest first.

    Each sweep meets every pair of columns once, in rounds of disjoint pairs
    that are rotated together.
    """
    g = np.array(g, float)
    r = g.shape[1]
    ring = list(range(r + r % 2))  # an odd number of columns has one that sits a round out
    for _ in range(sweeps if r > 1 else 0):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[: len(ring) // 2], ring[::-1]) if max(p, q) < r]
            i, j = np.array(pairs).T
            x, y = g[:, i], g[:, j]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > 1e-16
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = c * x - c * t * y, c * t * x + c * y
            ring.insert(1, ring.pop())
        if worst < 1e-15:
            break
    return g[:, np.argsort(-(g * g).sum(0), kind="stable")]


@dataclass
class Whitening:
    """n fitted vectors, their exact sums, and the first components with their eigenvalues of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray  # (d, k)
    eigenvalues: np.ndarray  # (k,)
    trace: float
    identity_error: float | None = None

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray):
        """(n x - S as exact integers, x - S/n as doubles); 64-bit integers where they are sure to hold the squares' sum."""
        top = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        wide = top * top * max(1, self.dimension) >= 1 << 63
        kind = object if wide else np.int64
        exact = x.astype(kind) * self.n - np.array(self.sums, kind)
        return exact, (exact / self.n).astype(float)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.components / np.sqrt(self.eigenvalues)


def _grid(vectors, scale: int):
    """(kept rows, list of integer vectors): floor(scale * c) where every entry is there and finite.

    Entries whose integer wouldn't fit 62 bits make the vector count as not finite.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = vectors.cast(pa.large_list(pa.float64()))
    rows = np.flatnonzero(np.asarray(lists.is_valid()))
    lists = lists.take(pa.array(rows))
    flat = lists.flatten()
    size = np.asarray(pc.list_value_length(lists), np.int64)
    stop = np.cumsum(size)
    values = scale * np.asarray(flat.fill_null(np.nan))
    bad = np.r_[0, np.cumsum(~(np.abs(values) < 2.0**62))]
    good = bad[stop] == bad[stop - size]
    whole = np.floor(np.where(np.abs(values) < 2.0**62, values, 0.0)).astype(np.int64)
    return rows[good], [whole[b - s : b] for b, s in zip(stop[good], size[good])]


def _stack(vectors: list[np.ndarray], dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(which have the dimension, those as a matrix)."""
    which = np.array([i for i, v in enumerate(vectors) if len(v) == dimension], np.int64)
    return which, np.array([vectors[i] for i in which], np.int64).reshape(len(which), dimension)


def distinct_vectors(rows: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """(x): every distinct vector of integers once."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            _, x = _grid(b.column(0), scale)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int64()))], names=["x"])

    return rows.select(F.col(f"`{vector_col}`").alias("v")).mapInArrow(run, "x array<long>").distinct()


def _exact_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and their sum in every dimension, as integers of any size."""
    from decimal import Decimal

    import pyarrow as pa

    def run(batches):
        n, total = 0, np.zeros(dimension, object)
        for b in batches:
            _, x = _stack([v.values.to_numpy() for v in b.column(0)], dimension)
            n += len(x)
            safe = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
            total += (x if safe else x.astype(object)).sum(0)
        sums = [Decimal(int(t)) for t in total]
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums], pa.list_(pa.decimal128(38, 0)))], names=["n", "s"])

    parts = fit.mapInArrow(run, "n long, s array<decimal(38,0)>")
    each = parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found = {r.i: r for r in each.collect()}
    return (found[0].n if found else 0), [int(found[i].s) if i in found else 0 for i in range(dimension)]


def _summed(fit: DataFrame, dimension: int, size: int, part) -> np.ndarray:
    """Sum over all batches of ``part(matrix)``, a vector of ``size`` numbers."""
    import pyarrow as pa

    def run(batches):
        acc = np.zeros(size)
        for b in batches:
            _, x = _stack([v.values.to_numpy() for v in b.column(0)], dimension)
            if len(x):
                acc += part(x)
        yield pa.RecordBatch.from_arrays([pa.array([acc.astype("<f8").tobytes()], pa.binary())], names=["v"])

    return sum_vectors(fit.mapInArrow(run, "v binary"), size)


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = 4, scale: int = 256) -> Whitening | None:
    """The whitening learned from every distinct vector of integers floor(scale * entry); None if no vector is left.

    Vectors that are null or hold null or non-finite entries are left out. The
    space is that of the commonest length of the distinct vectors, of equally
    common ones the greatest; vectors of other lengths are not in it. Constant
    dimensions and vectors that span less than the space give fewer components.
    The distinct vectors are written to the shared folder once and read three
    times; the driver receives one scatter matrix from each of at most 32 tasks.
    """
    distinct = stored(distinct_vectors(rows, vector_col, scale), "vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(1)
    if not lengths or not lengths[0].d:
        return None
    d = lengths[0].d
    n, sums = _exact_sums(distinct, d)
    w = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)

    def scatter(x):
        c = w.centred(x)[1]
        return (c.T @ c)[np.triu_indices(d)]

    a = np.zeros((d, d))
    a[np.triu_indices(d)] = _summed(distinct, d, d * (d + 1) // 2, scatter) / n
    a = a + np.triu(a, 1).T
    turned = one_sided_jacobi(pivoted_cholesky(a))
    norms = np.sqrt((turned * turned).sum(0))
    k = min(components, int((norms > 0).sum()))
    fitted = Whitening(n, sums, turned[:, :k] / norms[:k], norms[:k] ** 2, float(np.trace(a)))
    if k:
        mean = _summed(distinct, d, k, lambda x: fitted.whiten(fitted.centred(x)[1]).sum(0)) / n

        def spread(x):
            v = fitted.whiten(fitted.centred(x)[1]) - mean
            return (v.T @ v).reshape(-1)

        error = _summed(distinct, d, k * k, spread).reshape(k, k) / n - np.eye(k)
        fitted.identity_error = float(np.abs(error).max())
    return fitted


def whiten(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per vector of the space and component.

    deviation is the exact sum over the dimensions of (n x - S)²; null where it
    passes 63 bits. Repeated rows give repeated rows, a null id comes back as
    null, other columns are not read; without a model (empty table) there are no
    rows. Equal eigenvalues keep the order in which the rotations left them, the
    same for all rows.
    """
    import pyarrow as pa

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def run(batches):
        if model is None:
            return
        k = len(model.eigenvalues)
        for b in batches:
            at, vectors = _grid(b.column(1), scale)
            which, x = _stack(vectors, model.dimension)
            exact, centred = model.centred(x)
            squares = (exact * exact).sum(1)
            deviation = [int(s) if int(s) < 1 << 63 else None for s in squares]
            rows = len(which)
            columns = [
                b.column(0).take(pa.array(np.repeat(at[which], k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)),
                pa.array([v for v in deviation for _ in range(k)], pa.int64()),
                pa.array(model.whiten(centred).reshape(-1)),
                pa.array(np.tile(model.eigenvalues / model.trace if k else model.eigenvalues, rows)),
                pa.array(np.full(rows * k, model.identity_error if k else 0.0)),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names=names)

    picked = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return picked.mapInArrow(run, schema)
