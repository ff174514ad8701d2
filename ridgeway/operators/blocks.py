"""A point table packed into blocks of rows: one matrix and one label vector per row, cached for iterative jobs.

A step of a fit reads the blocks as matrices, without turning rows into
batches again, and takes its weights in the task closure: nothing is compiled
for new weights. Every task returns one packed vector.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.points import PointSet
from .loss_grad import batch_matrix
from .tree_sum import MERGERS, PACKED, collect_sum, packed

BLOCK_BYTES, MOST_ROWS = 1 << 18, 2048  # a block's features, and its rows: what is computed of them stays in the processor's cache
BATCH_BYTES = 1 << 20  # blocks handed to a Python worker at once; Arrow grows larger batches by copying them


def _block_rows(d: int) -> int:
    return min(MOST_ROWS, max(1, BLOCK_BYTES // (8 * max(1, d))))


@contextmanager
def small_arrow_batches(spark, d: int):
    """While a job over blocks runs, Arrow batches hold about ``BATCH_BYTES`` of them instead of as many blocks as rows elsewhere."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(1, BATCH_BYTES // (8 * max(1, d) * _block_rows(d)))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def packed_blocks(points: PointSet) -> DataFrame:
    """(y, x): labels and row-major features of consecutive rows as binary float64, at most about ``BLOCK_BYTES`` a block."""
    feats, label, vector, d = list(points.features), points.label, points.vector, points.d
    rows = _block_rows(d)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            if b.num_rows == 0:
                continue
            X = np.ascontiguousarray(batch_matrix(b, feats, vector, d), "<f8")
            y = b.column(label).to_numpy(zero_copy_only=False).astype("<f8")
            cuts = range(0, len(y), rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[i : i + rows].tobytes() for i in cuts], pa.binary()) for m in (y, X)], names=["y", "x"]
            )

    return points.df.select(*points.feature_columns(), label).mapInArrow(run, "y binary, x binary")


class PointBlocks:
    """Cached blocks of a point table, and sums over them."""

    def __init__(self, points: PointSet):
        self.d = points.d
        self.df = packed_blocks(points).persist(StorageLevel.MEMORY_AND_DISK)
        # fills the cache; where few tasks hold points, their vectors go to the driver without a merge
        self.tasks = self.df.select(F.spark_partition_id().alias("p")).distinct().count()

    def matrices(self):
        """A function that reads (X, y) from an Arrow batch of blocks."""
        d = self.d

        def read(b):
            for y, x in zip(b.column(0), b.column(1)):
                yield np.frombuffer(x.as_buffer(), "<f8").reshape(-1, d), np.frombuffer(y.as_buffer(), "<f8")

        return read

    def summed(self, size: int, add) -> np.ndarray:
        """Sum over all blocks of what ``add(total, X, y)`` adds to a vector of ``size`` numbers."""
        read = self.matrices()

        def run(batches):
            total = np.zeros(size)
            for b in batches:
                for X, y in read(b):
                    add(total, X, y)
            yield packed(total)

        return self.collect(run, size)

    def collect(self, run, size: int) -> np.ndarray:
        """The sum of the packed vectors that ``run`` makes of each task's Arrow batches of blocks."""
        with small_arrow_batches(self.df.sparkSession, self.d):
            return collect_sum(self.df.mapInArrow(run, PACKED), size, self.tasks if self.tasks <= MERGERS else None)

    def gram_product(self, V: np.ndarray) -> np.ndarray:
        """XᵀX V without XᵀX: one scan, d numbers per column of V."""
        V = np.asarray(V, float).reshape(self.d, -1)

        def add(total, X, y):
            total += (X.T @ (X @ V)).reshape(-1)

        return self.summed(V.size, add).reshape(V.shape)

    def label_product(self) -> tuple[float, np.ndarray, float]:
        """n, Xᵀy and yᵀy."""

        def add(total, X, y):
            total[0] += len(y)
            total[1] += y @ y
            total[2:] += y @ X

        t = self.summed(self.d + 2, add)
        return float(t[0]), t[2:], float(t[1])

    def close(self) -> None:
        self.df.unpersist()

    def __enter__(self) -> "PointBlocks":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def lanczos_largest(product, d: int, tol: float = 1e-9, most: int = 200, seed: int = 0) -> float:
    """Largest eigenvalue of a symmetric positive semidefinite matrix given by ``product(v)``.

    Lanczos with full reorthogonalisation; the driver keeps one vector per
    step. Stops when the largest Ritz value's residual bound is below ``tol``
    of it, or when the Krylov space is exhausted.
    """
    v = np.random.default_rng(seed).standard_normal(d)
    basis, alpha, beta = [v / np.linalg.norm(v)], [], []
    value = 0.0
    for _ in range(min(most, d)):
        u = np.asarray(product(basis[-1]), float).reshape(-1)
        alpha.append(float(basis[-1] @ u))
        Q = np.array(basis)
        for _ in range(2):
            u = u - Q.T @ (Q @ u)
        values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta, 1) + np.diag(beta, -1))
        value, size = float(values[-1]), float(np.linalg.norm(u))
        if size * abs(vectors[-1, -1]) <= tol * max(value, np.finfo(float).tiny):
            break
        beta.append(size)
        basis.append(u / size)
    return value


def conjugate_gradient(product, b: np.ndarray, tol: float = 1e-10, most: int = 1000) -> tuple[np.ndarray, int]:
    """Solution of A w = b for a symmetric positive definite A given by ``product(p)``, and the steps taken.

    Stops when ‖b − A w‖ < tol ‖b‖; A that isn't definite along a direction ends the search there.
    """
    b = np.asarray(b, float)
    w, r = np.zeros_like(b), b.copy()
    p, rr = r.copy(), float(r @ r)
    goal = (tol * float(np.linalg.norm(b))) ** 2
    steps = 0
    while rr > goal and steps < most:
        q = np.asarray(product(p), float).reshape(-1)
        curve = float(p @ q)
        if curve <= 0:
            break
        w = w + (rr / curve) * p
        r = r - (rr / curve) * q
        new = float(r @ r)
        p, rr, steps = r + (new / rr) * p, new, steps + 1
    return w, steps


def ridge(points: PointSet, lam: float, tol: float = 1e-10, most: int = 1000) -> tuple[np.ndarray, int]:
    """E9 at any width: (XᵀX + λI) w = Xᵀy by conjugate gradients, one scan of cached blocks a step."""
    with PointBlocks(points) as blocks:
        n, xty, _ = blocks.label_product()
        if n == 0:
            raise ValueError("empty point table")
        return conjugate_gradient(lambda p: blocks.gram_product(p)[:, 0] + lam * p, xty, tol, most)


def largest_gram_eigenvalue(points: PointSet, scale: str = "mean", tol: float = 1e-9) -> float:
    """C8 at any width: the largest eigenvalue of XᵀX (``sum``) or XᵀX/n (``mean``) by Lanczos, one scan a step."""
    with PointBlocks(points) as blocks:
        n, _, _ = blocks.label_product()
        if n == 0:
            raise ValueError("empty point table")
        value = lanczos_largest(lambda v: blocks.gram_product(v)[:, 0], points.d, tol)
    return value / n if scale == "mean" else value
