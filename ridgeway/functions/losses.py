"""Pointwise losses (B6-B10) in two matching forms.

* Column form: ``pointwise(margins, label) -> (loss, dloss)`` builds JVM
  expressions (kept inside whole-stage codegen) for the loss and its
  derivative with respect to each margin. The gradient with respect to
  weight (c, j) is ``dloss_c * x_j``.
* NumPy form: ``numpy(Z, y) -> (loss, D)`` does the same for one Arrow batch,
  used by the ``mapInArrow`` evaluators.

A loss is a generalised linear one: it sees the data only through the
margins ``z_c = x . w_c`` and the label. ``CustomLoss`` (G1) lets a user
plug any such pair of functions into the same aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


# Products that one margin writes out as a sum. Both forms add from left to right, so they give the same
# number; the written-out one is compiled, the one over arrays keeps the plan flat whatever the width.
WRITTEN_OUT = 128


def sql_double(v: float) -> str:
    """A double as SQL, digit for digit."""
    v = float(v)
    if v != v or v in (float("inf"), float("-inf")):
        return f"CAST('{v}' AS DOUBLE)"
    return f"{v!r}D"


def weights_array(weights: Sequence[float]) -> str:
    """The weights as one SQL array, digit for digit. Spark folds it to a single literal; until then it is one string,
    so that the plan is as small for ten thousand weights as for ten."""
    return f"CAST(split('{','.join(repr(float(w)) for w in weights)}', ',') AS ARRAY<DOUBLE>)"


def _sum_of_products(pairs: Column) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda total, term: total + term)


def vector_margin(weights: Sequence[float], vector: str | Column) -> Column:
    """B6 on one array column: x . w as a left-to-right sum, for any length."""
    x = F.col(vector) if isinstance(vector, str) else vector
    return _sum_of_products(F.zip_with(x, F.expr(weights_array(weights)), lambda x, w: w * x))


def linear_margin(weights: Sequence[float], features: Sequence[str | Column]) -> Column:
    """X . w as a left-to-right sum of products, for any number of columns."""
    columns = [F.col(x) if isinstance(x, str) else x for x in features]
    if not columns or not len(weights):
        raise ValueError("no features")
    if len(columns) > WRITTEN_OUT:
        return vector_margin(weights, F.array(*columns))
    acc: Column | None = None
    for w, x in zip(weights, columns):
        term = F.lit(float(w)) * x
        acc = term if acc is None else acc + term
    return acc


def _pm1(label: Column) -> Column:
    """The label itself when it is ±1; otherwise the job fails (no silent 0/1 labels)."""
    return F.when((label == 1.0) | (label == -1.0), label).otherwise(
        F.raise_error(F.lit("binary losses need labels -1 or +1")).cast("double")
    )


def _check_pm1(y: np.ndarray) -> None:
    if not np.all(np.abs(y) == 1.0):
        raise ValueError("binary losses need labels -1 or +1")


class Loss:
    name = "loss"
    multiclass = False
    differentiable = True
    has_columns = True  # ``pointwise`` (or a batch loss's ``column_fn``) is given
    has_numpy = True  # ``numpy`` (or ``batch_fn``) is given

    def n_margins(self, n_classes: int | None) -> int:
        return 1

    def pointwise(self, margins: Sequence[Column], label: Column) -> tuple[Column, list[Column]]:
        raise NotImplementedError

    def numpy(self, Z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def numpy_many(self, Z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Single-margin losses for M models at once: Z is (n, M); returns (n, M) loss and derivative."""
        out = [self.numpy(Z[:, m : m + 1], y) for m in range(Z.shape[1])]
        return np.column_stack([o[0] for o in out]), np.column_stack([o[1][:, 0] for o in out])

    def numpy_many_sums(self, Z: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Loss sums of M single-margin models, where no derivative is asked for."""
        return self.numpy_many(Z, y)[0].sum(axis=0)


class LogisticLoss(Loss):
    """log(1 + exp(-y z)) for y in {-1, +1}, in an overflow-free form."""

    name = "logistic"

    def pointwise(self, margins, label):
        label = _pm1(label)
        m = label * margins[0]
        loss = F.greatest(-m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))
        dloss = -label / (F.exp(m) + 1.0)
        return loss, [dloss]

    def numpy(self, Z, y):
        _check_pm1(y)
        m = y * Z[:, 0]
        tail = np.exp(-np.abs(m))
        total = tail + 1.0
        loss = np.log(total) - np.minimum(m, 0.0)  # 1e-16 from log1p, and much faster
        np.copyto(tail, 1.0, where=m < 0.0)
        d = tail / total  # exp(-m) / (1 + exp(-m)) from the one exponential
        d *= -y
        return loss, d[:, None]

    def numpy_many(self, Z, y):
        _check_pm1(y)
        yy = y[:, None]
        m = yy * Z
        loss = np.maximum(-m, 0.0) + np.log1p(np.exp(-np.abs(m)))
        with np.errstate(over="ignore"):
            d = -yy / (np.exp(m) + 1.0)
        return loss, d

    def numpy_many_sums(self, Z, y):
        _check_pm1(y)
        m = y[:, None] * Z
        tail = np.exp(-np.abs(m))
        tail += 1.0
        return (np.log(tail, out=tail) + np.maximum(-m, 0.0)).sum(axis=0)  # 1e-16 from log1p, and much faster


class HingeLoss(Loss):
    """max(0, 1 - y z); subgradient -y x where the loss is positive."""

    name = "hinge"
    differentiable = False

    def pointwise(self, margins, label):
        label = _pm1(label)
        m = label * margins[0]
        loss = F.greatest(F.lit(0.0), 1.0 - m)
        dloss = F.when(loss > 0, -label).otherwise(F.lit(0.0))
        return loss, [dloss]

    def numpy(self, Z, y):
        _check_pm1(y)
        m = y * Z[:, 0]
        loss = np.maximum(0.0, 1.0 - m)
        d = np.where(loss > 0, -y, 0.0)
        return loss, d[:, None]

    def numpy_many(self, Z, y):
        _check_pm1(y)
        yy = y[:, None]
        loss = np.maximum(0.0, 1.0 - yy * Z)
        return loss, np.where(loss > 0, -yy, 0.0)

    def numpy_many_sums(self, Z, y):
        _check_pm1(y)
        loss = Z * -y[:, None]
        loss += 1.0
        return np.maximum(loss, 0.0, out=loss).sum(axis=0)


class SquaredLoss(Loss):
    """0.5 (x.w - y)^2 with derivative (x.w - y)."""

    name = "squared"

    def pointwise(self, margins, label):
        r = margins[0] - label
        return F.lit(0.5) * r * r, [r]

    def numpy(self, Z, y):
        r = Z[:, 0] - y
        return 0.5 * r * r, r[:, None]

    def numpy_many(self, Z, y):
        r = Z - y[:, None]
        return 0.5 * r * r, r


class SoftmaxLoss(Loss):
    """-z_y + log sum_c exp(z_c), max-shifted; derivative p_c - [c = y]."""

    name = "softmax"
    multiclass = True

    def n_margins(self, n_classes):
        if not n_classes:
            raise ValueError("softmax needs the number of classes")
        return n_classes

    def pointwise(self, margins, label):
        mx = F.greatest(*margins) if len(margins) > 1 else margins[0]
        total = None
        for z in margins:
            e = F.exp(z - mx)
            total = e if total is None else total + e
        lse = mx + F.log(total)
        # a label outside 0..C-1 fails the job instead of dropping out of the sums
        picked = F.raise_error(F.lit(f"class labels must lie in 0..{len(margins) - 1}")).cast("double")
        for c in range(len(margins) - 1, -1, -1):
            picked = F.when(label == c, margins[c]).otherwise(picked)
        loss = lse - picked
        dl = [F.exp(z - lse) - F.when(label == c, F.lit(1.0)).otherwise(F.lit(0.0)) for c, z in enumerate(margins)]
        return loss, dl

    def numpy(self, Z, y):
        yi = y.astype(np.int64)
        if len(yi) and (yi.min() < 0 or yi.max() >= Z.shape[1] or not np.array_equal(yi, y)):
            raise ValueError(f"class labels must lie in 0..{Z.shape[1] - 1}")
        z, rows = np.array(Z.T, order="C"), np.arange(len(yi))  # a row per class: all passes run along the points
        z -= z.max(axis=0)
        loss = -z[yi, rows]
        np.exp(z, out=z)
        total = z.sum(axis=0)
        loss += np.log(total)
        z /= total
        z[yi, rows] -= 1.0
        return loss, z.T


class CustomLoss(Loss):
    """G1: a user-defined generalised linear loss.

    ``column_fn(margin, label) -> (loss, dloss)`` works on Columns and keeps the
    aggregate JVM-side; ``numpy_fn(z, y) -> (loss, dloss)`` is optional and is
    used by the Arrow strategies.
    """

    def __init__(
        self,
        name: str,
        column_fn: Callable[[Column, Column], tuple[Column, Column]],
        numpy_fn: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
        differentiable: bool = True,
    ):
        self.name = name
        self._col = column_fn
        self._np = numpy_fn
        self.has_numpy = numpy_fn is not None
        self.differentiable = differentiable

    def pointwise(self, margins, label):
        loss, d = self._col(margins[0], label)
        return loss, [d]

    def numpy(self, Z, y):
        if self._np is None:
            raise NotImplementedError(f"{self.name}: no NumPy form given; use the Column strategy")
        loss, d = self._np(Z[:, 0], y)
        return np.asarray(loss, dtype=float), np.asarray(d, dtype=float)[:, None]


class BatchLoss(Loss):
    """G1 for losses that are not functions of the margins.

    ``batch_fn(X, y, W) -> (loss_sum, grad_sum)`` receives one Arrow batch as a
    NumPy matrix X (rows × d), the labels y and the weights W (C × d) and returns
    the batch's loss sum and gradient sum (C × d). It runs inside ``mapInArrow``
    tasks; Spark sums the per-task partials. A ``column_fn`` giving the same
    per-row loss and gradient as Columns lets the evaluator stay in the JVM.
    """

    def __init__(self, name: str, batch_fn, n_margins: int = 1, differentiable: bool = True, column_fn=None):
        self.name = name
        self.batch_fn = batch_fn
        self._C = n_margins
        self.differentiable = differentiable
        # optional JVM form: column_fn(W, features, label) -> (loss Column, [C*d gradient Columns])
        self.column_fn = column_fn
        self.has_columns = column_fn is not None

    def n_margins(self, n_classes):
        return self._C

    def pointwise(self, margins, label):
        raise NotImplementedError(f"{self.name} is a batch loss: use the Arrow strategy")


LOSSES: dict[str, Loss] = {
    "logistic": LogisticLoss(),
    "hinge": HingeLoss(),
    "squared": SquaredLoss(),
    "softmax": SoftmaxLoss(),
}


def get_loss(loss: str | Loss) -> Loss:
    return LOSSES[loss] if isinstance(loss, str) else loss


def quadratic_bowl(w: Sequence[Column], A: Sequence[Sequence[Column | float]], mu: Sequence[Column | float]) -> Column:
    """(w - mu)^T A (w - mu) as a Column over a table of points w.

    A and mu may be literals or Columns (e.g. moments joined to a grid).
    """
    def lit(v):
        return v if isinstance(v, Column) else F.lit(float(v))

    diff = [wi - lit(m) for wi, m in zip(w, mu)]
    acc = None
    for i, di in enumerate(diff):
        for j, dj in enumerate(diff):
            term = di * lit(A[i][j]) * dj
            acc = term if acc is None else acc + term
    return acc
