"""Fits that outlive their driver: a table of every evaluation, written as the fit runs and replayed by the next one.

A trainer is a deterministic loop over the answers of its evaluator, and only
those cost Spark jobs. ``LoggedEvaluator`` appends each answer with its weights to a
Parquet table. A fit that is started again on that table gets the stored
answers first, in their order and without a job, comes to the point where the
earlier one stopped with the same state (weights, step size, curvature pairs,
momentum), and goes on from there; every solver resumes alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .loss_grad import Evaluator

LOG_SCHEMA = "seq int, place int, n double, loss double, weights array<double>, gradient array<double>"


def read_evaluations(spark: SparkSession, path: str) -> DataFrame:
    """The stored evaluations: call ``seq``, candidate ``place`` within it, points, sum of losses, weights, sum of gradients.

    Weights and gradients are (classes × features) arrays laid out by class. A
    path without a table gives no rows.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


class LoggedEvaluator(Evaluator):
    """``inner`` with a table of its answers at ``path``, in a folder that outlives the driver.

    Answers are appended ``every`` calls at a time and on closing, each time as one
    file that is there whole or not at all, so a lost driver costs at most
    ``every`` calls. Stored answers are streamed back, never held together. A
    stored call whose weights aren't those asked for belongs to another fit
    (other start, solver or settings) and is an error; that the points are the same
    is the caller's to know. Stored calls left over when the fit ends are kept.
    One fit at a time may use a path.
    """

    def __init__(self, inner: Evaluator, spark: SparkSession, path: str, every: int = 20):
        if every < 1:
            raise ValueError("every must be at least 1")
        self.inner, self.spark, self.path, self.every = inner, spark, path, every
        self.n_margins, self.d = inner.n_margins, inner.d
        self.replayed = self.calls = 0
        self._rows: list[tuple] = []
        self._held = 0
        self._stored = read_evaluations(spark, path).orderBy("seq", "place").toLocalIterator()
        self._next = next(self._stored, None)

    @property
    def jobs(self) -> int:
        return getattr(self.inner, "jobs", 0)

    def _replay(self, Ws: np.ndarray):
        """The stored answer to the next call, or None where the table ends."""
        if self._next is None:
            return None
        seq, rows = self.calls, []
        while self._next is not None and self._next.seq == seq:
            rows.append(self._next)
            self._next = next(self._stored, None)
        same = len(rows) == len(Ws) and all(
            np.array_equal(np.asarray(r.weights, float), W.reshape(-1), equal_nan=True) for r, W in zip(rows, Ws)
        )
        if not same:
            raise ValueError(f"{self.path} holds the evaluations of another fit: call {seq} differs")
        self.replayed += 1
        grads = None if rows[0].gradient is None else np.array([r.gradient for r in rows], float).reshape(Ws.shape)
        return rows[0].n, np.array([r.loss for r in rows], float), grads

    def _answer(self, Ws, with_grad: bool, live):
        Ws = np.asarray(Ws, dtype=float).reshape(-1, self.n_margins, self.d)
        found = self._replay(Ws)
        if found is None:
            n, losses, grads = found = live(Ws)
            for k, W in enumerate(Ws):
                g = np.asarray(grads[k], float).reshape(-1).tolist() if with_grad else None
                self._rows.append((self.calls, k, float(n), float(losses[k]), W.reshape(-1).tolist(), g))
            self._held += 1
            if self._held >= self.every:
                self.flush()
        self.calls += 1
        return found

    def evaluate(self, W):
        def live(Ws):
            n, loss, grad = self.inner.evaluate(Ws[0])
            return n, np.array([loss]), np.asarray(grad, float)[None]

        n, losses, grads = self._answer([W], True, live)
        return n, float(losses[0]), grads[0]

    def evaluate_many(self, Ws, with_grad: bool = True):
        return self._answer(Ws, with_grad, lambda Ws: self.inner.evaluate_many(Ws, with_grad))

    def flush(self) -> None:
        """Append what the table lacks."""
        if self._rows:
            self.spark.createDataFrame(self._rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self._rows, self._held = [], 0

    def close(self) -> None:
        try:
            self.flush()
        finally:
            self.inner.close()
