"""Second moments of a point table (C5), the Lipschitz step (C8), closed-form
ridge (E9) and a squared-loss evaluator that needs no further pass over the
data once the moments are known.

One scan computes n, Xᵀy, yᵀy and the upper triangle of XᵀX: as a single
Column aggregate for narrow tables, or as per-task ``X.T @ X`` partials from
``mapInArrow``, one packed triangle per task, summed in a tree. Only the
(d+1)² moment matrix reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.points import PointSet
from .loss_grad import Evaluator, as_matrix, batch_matrix
from .tree_sum import MERGERS, PACKED, collect_sum, packed, tree_sum

COLUMN_FORM_MAX_D = 12
MAX_DRIVER_D = 2000  # beyond it the moment matrix outgrows the driver; row steps need no such matrix


def moments_frame(points: PointSet) -> DataFrame:
    """C5 in long form: ``(i, j, value, n)`` with index 0 the label, 1..d the features.

    ``value`` is Σ v_i v_j over all rows for v = (y, x1, .., xd); both triangles
    are listed.
    """
    cols = [points.label] + list(points.features)
    k = len(cols)
    if points.d <= COLUMN_FORM_MAX_D and not points.vector:
        aggs = [F.count(F.lit(1)).alias("n")]
        aggs += [
            F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"m_{i}_{j}") for i in range(k) for j in range(i, k)
        ]
        row = points.df.select(*cols).agg(*aggs)
        entries = []
        for i in range(k):
            for j in range(k):
                a, b = (i, j) if i <= j else (j, i)
                entries.append(
                    F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"m_{a}_{b}").alias("value"))
                )
        return row.select("n", F.explode(F.array(*entries)).alias("e")).select(
            F.col("e.i").cast("int").alias("i"), F.col("e.j").cast("int").alias("j"), "e.value", "n"
        )
    if points.d > MAX_DRIVER_D:
        return moments_from_blocks(gram_blocks(points), points.d)
    return _moments_long(points)


def _moment_parts(points: PointSet) -> DataFrame:
    """One packed vector per task: n, then the upper triangle of Σ v vᵀ row by row, v = (y, x1, .., xd)."""
    feats, label, vector, d = list(points.features), points.label, points.vector, points.d

    def fn(batches):
        acc = np.zeros((d + 1, d + 1))
        n = 0
        for b in batches:
            if b.num_rows == 0:
                continue
            y = b.column(label).to_numpy(zero_copy_only=False).astype(float, copy=False)
            V = np.column_stack([y, batch_matrix(b, feats, vector, d)])
            acc += V.T @ V
            n += V.shape[0]
        if n:
            yield packed(np.r_[float(n), acc[np.triu_indices(d + 1)]])

    return points.df.select(*points.feature_columns(), label).mapInArrow(fn, PACKED)


def _moments_long(points: PointSet) -> DataFrame:
    k = points.d + 1

    def lay_out(batches):
        import pyarrow as pa

        for b in batches:
            for v in b.column("v"):
                v = np.frombuffer(v.as_py(), "<f8")
                M = np.zeros((k, k))
                M[np.triu_indices(k)] = v[1:]
                M = M + np.triu(M, 1).T
                i, j = (x.reshape(-1).astype(np.int32) for x in np.indices((k, k)))
                cols = [i, j, M.reshape(-1), np.full(k * k, int(v[0]))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["i", "j", "value", "n"])

    return tree_sum(_moment_parts(points)).mapInArrow(lay_out, "i int, j int, value double, n long")


@dataclass
class Moments:
    n: float
    xtx: np.ndarray  # (d, d)
    xty: np.ndarray  # (d,)
    yty: float

    @property
    def d(self) -> int:
        return self.xtx.shape[0]


def collect_moments(points: PointSet) -> Moments:
    """The moment matrix on the driver ((d+1)² numbers, d ≤ 2000)."""
    if points.d > MAX_DRIVER_D:
        raise ValueError(f"{points.d} features: the moment matrix is too large for the driver")
    k = points.d + 1
    M = np.zeros((k, k))
    if points.d <= COLUMN_FORM_MAX_D and not points.vector:
        n = 0.0
        for r in moments_frame(points).collect():
            if r["n"]:
                M[r["i"], r["j"]] = r["value"]
                n = float(r["n"])
    else:
        v = collect_sum(_moment_parts(points), 1 + k * (k + 1) // 2)
        n = float(v[0])
        M[np.triu_indices(k)] = v[1:]
        M = M + np.triu(M, 1).T
    if n == 0:
        raise ValueError("empty point table")
    return Moments(n=n, xtx=M[1:, 1:], xty=M[1:, 0], yty=float(M[0, 0]))


def ridge_closed_form(m: Moments, lam: float) -> np.ndarray:
    """pinv(XᵀX + λI) Xᵀy on unnormalised sums (every weight penalised)."""
    return np.linalg.pinv(m.xtx + lam * np.eye(m.d)) @ m.xty


def lipschitz_constant(m: Moments, scale: str = "mean") -> float:
    """Largest eigenvalue of XᵀX/n (mean squared loss) or of XᵀX (sum)."""
    A = m.xtx / m.n if scale == "mean" else m.xtx
    return float(np.linalg.eigvalsh(A).max())


def largest_eigenvalue(points: PointSet, scale: str = "mean") -> float:
    """C8 of a point table of any width: from the moment matrix, or by Lanczos over the points beyond ``MAX_DRIVER_D``."""
    if points.d <= MAX_DRIVER_D:
        return lipschitz_constant(collect_moments(points), scale)
    from .blocks import largest_gram_eigenvalue

    return largest_gram_eigenvalue(points, scale)


def fit_ridge(points: PointSet, lam: float) -> np.ndarray:
    """E9 of a point table of any width: closed form from the moments, or conjugate gradients beyond ``MAX_DRIVER_D``."""
    if points.d <= MAX_DRIVER_D:
        return ridge_closed_form(collect_moments(points), lam)
    from .blocks import ridge

    return ridge(points, lam)[0]


def gram_blocks(points: PointSet, width: int = 1024) -> DataFrame:
    """C5 by column blocks: ``(bi, bj, n, block)`` for bi <= bj, the sum over all rows of v_bi v_bjᵀ as row-major float64.

    v = (y, x1, .., xd) is cut into blocks of ``width`` columns. A task holds
    one Arrow batch of points and one product at a time; each product is
    added up under its own key, first within ``MERGERS`` shares of the tasks,
    then whole, as streams sorted by the key. No cell or task holds the matrix.
    """
    feats, label, vector, d = list(points.features), points.label, points.vector, points.d
    cuts = [(i, min(i + width, d + 1)) for i in range(0, d + 1, width)]
    schema = "bi int, bj int, share int, n long, block binary"
    names = ["bi", "bj", "share", "n", "block"]

    def products(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        share = TaskContext.get().partitionId() % MERGERS
        for b in batches:
            if b.num_rows == 0:
                continue
            y = b.column(label).to_numpy(zero_copy_only=False).astype(float, copy=False)
            V = np.column_stack([y, batch_matrix(b, feats, vector, d)])
            for i, (lo, hi) in enumerate(cuts):
                for j in range(i, len(cuts)):
                    part = V[:, lo:hi].T @ V[:, cuts[j][0] : cuts[j][1]]
                    row = [[i], [j], [share], [len(y)], [np.ascontiguousarray(part, "<f8").tobytes()]]
                    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=names)

    def added(batches):
        import pyarrow as pa

        key, n, total = None, 0, None

        def row():
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*key, n, total.tobytes()), types)], names=names)

        for b in batches:
            for *own, rows, block in zip(*b.columns):
                own, block = tuple(v.as_py() for v in own), np.frombuffer(block.as_buffer(), "<f8")
                if own != key:
                    if key is not None:
                        yield row()
                    key, n, total = own, 0, np.zeros(len(block))
                n += rows.as_py()
                total += block
        if key is not None:
            yield row()

    keys = ["bi", "bj", "share"]
    shares = points.df.select(*points.feature_columns(), label).mapInArrow(products, schema)
    shares = shares.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(added, schema)
    whole = shares.withColumn("share", F.lit(0)).repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInArrow(added, schema)
    return whole.select("bi", "bj", "n", "block")


def moments_from_blocks(blocks: DataFrame, d: int, width: int = 1024) -> DataFrame:
    """C5's long form ``(i, j, value, n)`` of ``gram_blocks``, both triangles; a task lays out one block at a time."""

    def lay_out(batches):
        import pyarrow as pa

        for b in batches:
            for bi, bj, n, block in zip(*b.columns):
                bi, bj, n = bi.as_py(), bj.as_py(), n.as_py()
                cols = min(width, d + 1 - bj * width)
                part = np.frombuffer(block.as_buffer(), "<f8").reshape(-1, cols)
                i, j = (x.reshape(-1) for x in np.indices(part.shape))
                i, j, value = i + bi * width, j + bj * width, part.reshape(-1)
                for a, c in ((i, j), (j, i))[: 1 + (bi != bj)]:
                    data = [pa.array(a.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(value), pa.array(np.full(len(value), n))]
                    yield pa.RecordBatch.from_arrays(data, names=["i", "j", "value", "n"])

    return blocks.mapInArrow(lay_out, "i int, j int, value double, n long")


class MomentsEvaluator(Evaluator):
    """Squared-loss sums from the moments: exact, and free after the first scan.

    Σ ½(x·w − y)² = ½(wᵀXᵀXw − 2wᵀXᵀy + yᵀy), gradient XᵀXw − Xᵀy.
    """

    def __init__(self, moments: Moments):
        self.m = moments
        self.n_margins = 1
        self.d = moments.d
        self.jobs = 0

    @classmethod
    def from_points(cls, points: PointSet) -> "MomentsEvaluator":
        ev = cls(collect_moments(points))
        ev.jobs = 1
        return ev

    def evaluate(self, W):
        w = as_matrix(W, 1, self.d)[0]
        xtxw = self.m.xtx @ w
        loss = 0.5 * (w @ xtxw - 2.0 * (w @ self.m.xty) + self.m.yty)
        return self.m.n, float(loss), (xtxw - self.m.xty)[None, :]
