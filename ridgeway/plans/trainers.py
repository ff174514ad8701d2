"""Iterative trainers.

Each trainer is a short driver loop over parameter-sized state (the weight
array, a BFGS matrix, a step size). All data-sized work is the evaluator's:
one Spark aggregate per step (``SparkEvaluator``) or none at all after the
first scan (``MomentsEvaluator`` for squared loss). Every fit records a trace
with one row per iterate, T steps giving T+1 rows, the last one at the
returned weights.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..operators.loss_grad import Evaluator
from ..operators.penalties import NoPenalty, Penalty, Projector, require_differentiable

TRACE_SCHEMA = (
    "run_id string, iter int, loss double, eta double, norm double, eval_point string, weights array<double>"
)
MODEL_SCHEMA = "model_id int, class_id int, feature_id int, weight double"


@dataclass
class FitResult:
    weights: np.ndarray
    objective: float
    status: str
    trace: list[tuple] = field(default_factory=list)  # (iter, loss, eta, norm, eval_point, weights)
    jobs: int = 0

    @property
    def iterations(self) -> int:
        return len(self.trace) - 1

    @property
    def path(self) -> np.ndarray:
        """Iterates w_0 .. w_T (T+1 entries, the first is the initial point)."""
        if any(row[5] is None for row in self.trace):
            raise ValueError("this fit did not keep its path (keep_path=False)")
        return np.array([row[5] for row in self.trace])

    @property
    def train_log(self) -> np.ndarray:
        """Logged objective per iterate; the last entry is the objective at the result."""
        return np.array([row[1] for row in self.trace])

    def trace_frame(self, spark: SparkSession, run_id: str) -> DataFrame:
        """The trace as a DataFrame (parameter-sized)."""
        rows = [
            (run_id, int(i), float(l), None if e is None else float(e), None if nm is None else float(nm), ep,
             None if w is None else [float(v) for v in np.asarray(w).reshape(-1)])
            for (i, l, e, nm, ep, w) in self.trace
        ]
        return spark.createDataFrame(rows, TRACE_SCHEMA)

    def model_frame(self, spark: SparkSession, model_id: int = 0) -> DataFrame:
        """Fitted weights as ``(model_id, class_id, feature_id, weight)``."""
        return spark.createDataFrame(model_rows(self.weights, model_id), MODEL_SCHEMA)


def model_rows(W, model_id: int = 0) -> list[tuple]:
    M = np.asarray(W, dtype=float)
    if M.ndim == 1:
        M = M[None, :]
    return [(int(model_id), c, j + 1, float(M[c, j])) for c in range(M.shape[0]) for j in range(M.shape[1])]


def _snapshot(keep_path: bool):
    """Copy of the iterate for the trace, or None when the caller doesn't want the path."""
    return (lambda w: np.asarray(w, dtype=float).copy()) if keep_path else (lambda w: None)


def step_size(lr: float, t: int, decay: bool) -> float:
    """η_t = lr, or lr/√t with t counted from 1."""
    return lr / math.sqrt(t) if decay else lr


def _check_args(n_iter: int, tol: float, lr: float) -> None:
    if n_iter <= 0:
        raise ValueError("n_iter must be positive")
    if tol < 1e-6:
        raise ValueError("tol must be at least 1e-6")
    if lr <= 0:
        raise ValueError("lr must be positive")


class _Objective:
    """Mean loss + λ·penalty, with a one-entry cache keyed by the weights."""

    def __init__(self, ev: Evaluator, penalty: Penalty, lam: float, shape):
        self.ev, self.pen, self.lam, self.shape = ev, penalty, lam, shape
        self._key = None
        self._val = None

    def _pack(self, w, n, lsum, G):
        w = np.asarray(w, dtype=float)
        loss = lsum / n
        grad = np.asarray(G, dtype=float).reshape(self.shape) / n
        return loss, grad

    def data(self, w):
        """(mean loss, mean gradient) of the data term at w."""
        key = np.asarray(w, dtype=float).tobytes()
        if key != self._key:
            n, lsum, G = self.ev.evaluate(np.asarray(w).reshape(self.ev.n_margins, self.ev.d))
            self._key, self._val = key, self._pack(w, n, lsum, G)
        return self._val

    def remember(self, w, loss, grad):
        self._key = np.asarray(w, dtype=float).tobytes()
        self._val = (loss, grad)

    def full(self, w):
        loss, grad = self.data(w)
        return loss + self.lam * self.pen.score(w), loss, grad

    def smooth_grad(self, w, grad):
        return grad + self.lam * np.asarray(self.pen.grad(w)).reshape(self.shape)

    def many(self, Ws, with_grad=True):
        n, lsums, G = self.ev.evaluate_many(
            np.asarray(Ws).reshape(len(Ws), self.ev.n_margins, self.ev.d), with_grad
        )
        return lsums / n, np.asarray(G).reshape((len(Ws),) + tuple(self.shape)) / n


def armijo_slope(g, direction, slope: str = "frobenius") -> float:
    """gᵀd for the Armijo bound: the Frobenius inner product, or for ``'sum_of_products'``
    the sum of all entries of Gᵀ D (= Σ_c (Σ_j g_cj)(Σ_j d_cj)), as the modelled library
    computes it for matrices."""
    g, d = np.asarray(g, dtype=float), np.asarray(direction, dtype=float)
    if slope == "sum_of_products" and g.ndim == 2:
        return float((g.T @ d).sum())
    return float(np.sum(g * d))


def batched_line_search(
    obj: _Objective, w, F0: float, g, direction, eta: float, c1: float, rho: float, batch: int, max_shrinks: int,
    slope: str = "frobenius",
):
    """First Armijo-accepted step among η ρ^m, m = 0, 1, ..., in batches.

    Candidates of one batch are evaluated in a single job; batches double in
    size when none passes. The accepted m is the same as a one-at-a-time search
    would find. Returns
    (eta, w_next, data_loss, data_grad) or None after ``max_shrinks``.
    """
    slope = armijo_slope(g, direction, slope)
    m0 = 0
    size = batch
    while m0 <= max_shrinks:
        ms = list(range(m0, min(m0 + size, max_shrinks + 1)))
        size = min(2 * size, 32)  # η carries over, so the first batch usually suffices; grow if not
        etas = [eta * rho**m for m in ms]
        cands = [w + e * direction for e in etas]
        if len(cands) == 1:
            loss, grad = obj.data(cands[0])
            losses, grads = np.array([loss]), np.array([grad])
        else:
            losses, grads = obj.many(cands)
        for k, e in enumerate(etas):
            Fk = losses[k] + obj.lam * obj.pen.score(cands[k])
            if Fk <= F0 + c1 * e * slope:  # a NaN candidate is never accepted
                obj.remember(cands[k], losses[k], grads[k])
                return e, cands[k], losses[k], grads[k]
        m0 += len(ms)
    return None


def gradient_descent(
    ev: Evaluator,
    w0,
    penalty: Penalty | None = None,
    lam: float = 0.0,
    lr: float = 1.0,
    c1: float = 0.3,
    rho: float = 0.9,
    n_iter: int = 2000,
    tol: float = 1e-6,
    batch: int = 2,
    max_shrinks: int = 100,
    keep_path: bool = True,
    slope: str = "frobenius",
) -> FitResult:
    """Steepest descent with Armijo backtracking; η carries over between steps.

    ``slope='sum_of_products'`` reproduces the modelled library's Armijo slope for
    matrix weights (see ``armijo_slope``).
    """
    return _descent(ev, w0, penalty, lam, lr, c1, rho, n_iter, tol, batch, max_shrinks, None, keep_path,
                    slope=slope)


def bfgs(
    ev: Evaluator,
    w0,
    penalty: Penalty | None = None,
    lam: float = 0.0,
    lr: float = 1.0,
    c1: float = 0.3,
    rho: float = 0.9,
    n_iter: int = 2000,
    tol: float = 1e-6,
    batch: int = 2,
    max_shrinks: int = 100,
    keep_path: bool = True,
    max_params: int = 2000,
    slope: str = "frobenius",
    curvature: str = "regularised",
    memory: int | None = None,
) -> FitResult:
    """Inverse-BFGS over the flattened weights with the same Armijo search.

    Up to ``max_params`` weights the inverse matrix is kept whole. Beyond, or
    with ``memory=m``, the direction comes from the last m pairs of steps and
    gradient differences (20 by default) by the two-loop recursion, so the
    driver holds 2m vectors and no matrix.

    The curvature pair uses the regularised gradient difference
    (``curvature='data'`` uses the data term's only, as the modelled library
    does); the update is skipped when sᵀy ≤ 1e-12 ‖s‖‖y‖.
    """
    if curvature not in ("regularised", "data"):
        raise ValueError("curvature must be 'regularised' or 'data'")
    if memory is None and np.asarray(w0).size > max_params:
        memory = 20
    if memory is not None and memory < 1:
        raise ValueError("memory must be at least 1")
    inverse = DenseInverse(np.asarray(w0).size) if memory is None else LimitedInverse(memory)
    return _descent(ev, w0, penalty, lam, lr, c1, rho, n_iter, tol, batch, max_shrinks, inverse, keep_path,
                    slope=slope, curvature=curvature)


class DenseInverse:
    """Inverse Hessian approximation as a matrix."""

    def __init__(self, size: int):
        self.B = np.eye(size)

    def times(self, g: np.ndarray) -> np.ndarray:
        return self.B @ g

    def update(self, s: np.ndarray, y: np.ndarray, sy: float) -> None:
        By = self.B @ y
        self.B = self.B + (sy + float(y @ By)) * np.outer(s, s) / (sy * sy) - (np.outer(By, s) + np.outer(s, By)) / sy


class LimitedInverse:
    """The same approximation from the last ``memory`` pairs (s, y), starting at the identity.

    As long as no pair has been dropped it is the dense one's product.
    """

    def __init__(self, memory: int):
        self.pairs: deque = deque(maxlen=memory)

    def times(self, g: np.ndarray) -> np.ndarray:
        q, along = np.array(g, float), []
        for s, y, sy in reversed(self.pairs):
            along.append(float(s @ q) / sy)
            q -= along[-1] * y
        if len(self.pairs) == self.pairs.maxlen:  # older curvature is gone: scale by the newest pair's
            s, y, sy = self.pairs[-1]
            q *= sy / float(y @ y)
        for s, y, sy in self.pairs:
            q += (along.pop() - float(y @ q) / sy) * s
        return q

    def update(self, s: np.ndarray, y: np.ndarray, sy: float) -> None:
        self.pairs.append((s, y, sy))


def _descent(ev, w0, penalty, lam, lr, c1, rho, n_iter, tol, batch, max_shrinks, inverse=None, keep_path=True,
             slope="frobenius", curvature="regularised"):
    _check_args(n_iter, tol, lr)
    penalty = penalty or NoPenalty()
    require_differentiable(penalty)
    w = np.asarray(w0, dtype=float).copy()
    shape = w.shape
    snap = _snapshot(keep_path)
    obj = _Objective(ev, penalty, lam, shape)
    eta = lr
    trace = []
    status = "max_iter"
    gnorm = None
    for i in range(n_iter):
        F0, loss, grad = obj.full(w)
        g = obj.smooth_grad(w, grad)
        gnorm = float(np.linalg.norm(g))
        if not (math.isfinite(F0) and math.isfinite(gnorm)):
            status = "not_finite"
            break
        if gnorm < tol:
            status = "converged"
            break
        direction = -inverse.times(g.reshape(-1)).reshape(shape) if inverse else -g
        found = batched_line_search(obj, w, F0, g, direction, eta, c1, rho, batch, max_shrinks, slope)
        if found is None:
            status = "line_search_failed"
            break
        eta, w_next, loss_n, grad_n = found
        trace.append((i, F0, eta, gnorm, "current", snap(w)))
        if inverse:
            s = (w_next - w).reshape(-1)
            if curvature == "data":
                y = (np.asarray(grad_n) - np.asarray(grad)).reshape(-1)
            else:
                y = (obj.smooth_grad(w_next, grad_n) - g).reshape(-1)
            sy = float(s @ y)
            if sy > 1e-12 * np.linalg.norm(s) * np.linalg.norm(y):
                inverse.update(s, y, sy)
        w = w_next
    Ffin, _, gfin = obj.full(w)
    fin_norm = float(np.linalg.norm(obj.smooth_grad(w, gfin)))
    trace.append((len(trace), Ffin, None, fin_norm, "current", w.copy()))
    return FitResult(w, Ffin, status, trace, getattr(ev, "jobs", 0))


def proximal_gradient(
    ev: Evaluator,
    w0,
    penalty: Penalty | None = None,
    lam: float = 0.0,
    lr: float = 1.0,
    lr_decay: bool = True,
    n_iter: int = 2000,
    tol: float = 1e-6,
    keep_path: bool = True,
) -> FitResult:
    """W ← prox(w − η∇f(w), ηλ); stops when ‖Δw‖ < tol."""
    _check_args(n_iter, tol, lr)
    penalty = penalty or NoPenalty()
    w = np.asarray(w0, dtype=float).copy()
    snap = _snapshot(keep_path)
    obj = _Objective(ev, penalty, lam, w.shape)
    trace = []
    status = "max_iter"
    for i in range(n_iter):
        F0, _, grad = obj.full(w)
        eta = step_size(lr, i + 1, lr_decay)
        w_next = penalty.prox(w - eta * grad, eta * lam)
        dnorm = float(np.linalg.norm(w_next - w))
        trace.append((i, F0, eta, dnorm, "current", snap(w)))
        w = w_next
        if not math.isfinite(dnorm):
            status = "not_finite"
            break
        if dnorm < tol:
            status = "converged"
            break
    Ffin, _, _ = obj.full(w)
    trace.append((len(trace), Ffin, None, None, "current", w.copy()))
    return FitResult(w, Ffin, status, trace, getattr(ev, "jobs", 0))


def accelerated_proximal(
    ev: Evaluator,
    w0,
    penalty: Penalty | None = None,
    lam: float = 0.0,
    lr: float = 1.0,
    lr_decay: bool = True,
    n_iter: int = 2000,
    tol: float = 1e-6,
    momentum: str = "published",
    keep_path: bool = True,
) -> FitResult:
    """Proximal step at an extrapolated point with momentum.

    ``momentum='published'`` uses c' = (1 + √(1+4c²))/2; ``'sqrt'`` uses
    c' = √(1+4c²)/2 as the modelled library does. The trace records the
    objective at the extrapolated point (eval_point='extrapolated'); the last
    row is at the returned weights.
    """
    _check_args(n_iter, tol, lr)
    if momentum not in ("published", "sqrt"):
        raise ValueError("momentum must be 'published' or 'sqrt'")
    penalty = penalty or NoPenalty()
    w = np.asarray(w0, dtype=float).copy()
    snap = _snapshot(keep_path)
    obj = _Objective(ev, penalty, lam, w.shape)
    # x_k = prox(y_k − η∇f(y_k)), y_{k+1} = x_k + β_k (x_k − x_{k−1}), β_k = (θ_k − 1)/θ_{k+1}
    shift = 1.0 if momentum == "published" else 0.0
    thetas = [1.0]
    point = w.copy()
    trace = []
    status = "max_iter"
    for i in range(n_iter):
        F_point, _, grad = obj.full(point)
        eta = step_size(lr, i + 1, lr_decay)
        x = penalty.prox(point - eta * grad, eta * lam)
        thetas.append((shift + math.sqrt(1.0 + 4.0 * thetas[-1] ** 2)) / 2.0)
        move = x - w
        dnorm = float(np.linalg.norm(move))
        trace.append((i, F_point, eta, dnorm, "extrapolated", snap(w)))
        point, w = x + move * ((thetas[-2] - 1.0) / thetas[-1]), x
        if not math.isfinite(dnorm):
            status = "not_finite"
            break
        if dnorm < tol:
            status = "converged"
            break
    Ffin, _, _ = obj.full(w)
    trace.append((len(trace), Ffin, None, None, "current", w.copy()))
    return FitResult(w, Ffin, status, trace, getattr(ev, "jobs", 0))


def projected_gradient(
    ev: Evaluator,
    w0,
    projector: Projector,
    lr: float = 1.0,
    lr_decay: bool = True,
    n_iter: int = 2000,
    tol: float = 1e-6,
    keep_path: bool = True,
) -> FitResult:
    """E5: w ← project(w − η∇f(w)); no penalty; logs the data loss."""
    _check_args(n_iter, tol, lr)
    w = np.asarray(w0, dtype=float).copy()
    snap = _snapshot(keep_path)
    obj = _Objective(ev, NoPenalty(), 0.0, w.shape)
    trace = []
    status = "max_iter"
    for i in range(n_iter):
        loss, grad = obj.data(w)
        eta = step_size(lr, i + 1, lr_decay)
        w_next = projector.project(w - eta * grad)
        dnorm = float(np.linalg.norm(w_next - w))
        trace.append((i, loss, eta, dnorm, "current", snap(w)))
        w = w_next
        if not math.isfinite(dnorm):
            status = "not_finite"
            break
        if dnorm < tol:
            status = "converged"
            break
    lfin, _ = obj.data(w)
    trace.append((len(trace), lfin, None, None, "current", w.copy()))
    return FitResult(w, lfin, status, trace, getattr(ev, "jobs", 0))


StepFn = Callable[[np.ndarray, dict, Callable[[np.ndarray], tuple[float, np.ndarray]]], tuple[np.ndarray, dict]]


def custom_optimizer(
    ev: Evaluator,
    w0,
    step: StepFn,
    penalty: Penalty | None = None,
    lam: float = 0.0,
    n_iter: int = 2000,
    tol: float = 1e-6,
    keep_path: bool = True,
) -> FitResult:
    """Run a user step function ``step(w, state, data_fn) -> (w_next, state)``.

    ``data_fn(w)`` returns the mean data loss and gradient at w (one Spark
    aggregate, cached per point). The loop stops when ‖Δw‖ < tol.
    """
    penalty = penalty or NoPenalty()
    w = np.asarray(w0, dtype=float).copy()
    snap = _snapshot(keep_path)
    obj = _Objective(ev, penalty, lam, w.shape)
    state: dict = {}
    trace = []
    status = "max_iter"
    for i in range(n_iter):
        F0, _, _ = obj.full(w)
        w_next, state = step(w, state, obj.data)
        w_next = np.asarray(w_next, dtype=float)
        dnorm = float(np.linalg.norm(w_next - w))
        trace.append((i, F0, state.get("eta"), dnorm, "current", snap(w)))
        w = w_next
        if dnorm < tol:
            status = "converged"
            break
    Ffin, _, _ = obj.full(w)
    trace.append((len(trace), Ffin, None, None, "current", w.copy()))
    return FitResult(w, Ffin, status, trace, getattr(ev, "jobs", 0))


def proximal_path(
    ev: Evaluator,
    w0,
    penalty: Penalty,
    lambdas,
    lr: float = 1.0,
    lr_decay: bool = True,
    n_iter: int = 2000,
    tol: float = 1e-6,
) -> list[FitResult]:
    """Proximal-gradient fits for every λ at once, one Spark job per step.

    Each step scores the stack of still-active models in one scan
    (``evaluate_many``); a model leaves the stack when its own ‖Δw‖ < tol, so
    every λ follows exactly the steps of ``proximal_gradient`` run alone.
    """
    _check_args(n_iter, tol, lr)
    lambdas = [float(l) for l in lambdas]
    w0 = np.asarray(w0, dtype=float)
    shape = w0.shape
    W = [w0.copy() for _ in lambdas]
    traces: list[list[tuple]] = [[] for _ in lambdas]
    status = ["max_iter"] * len(lambdas)
    active = list(range(len(lambdas)))

    def scores(idx):
        n, lsums, G = ev.evaluate_many(np.array([W[m] for m in idx]).reshape(len(idx), ev.n_margins, ev.d))
        return lsums / n, np.asarray(G).reshape((len(idx),) + shape) / n

    for i in range(n_iter):
        if not active:
            break
        losses, grads = scores(active)
        eta = step_size(lr, i + 1, lr_decay)
        still = []
        for k, m in enumerate(active):
            lam = lambdas[m]
            F0 = losses[k] + lam * penalty.score(W[m])
            w_next = penalty.prox(W[m] - eta * grads[k], eta * lam)
            dnorm = float(np.linalg.norm(w_next - W[m]))
            traces[m].append((i, F0, eta, dnorm, "current", W[m].copy()))
            W[m] = w_next
            if dnorm < tol:
                status[m] = "converged"
            else:
                still.append(m)
        active = still
    every = list(range(len(lambdas)))
    losses, _ = scores(every)
    out = []
    for m in every:
        Ffin = losses[m] + lambdas[m] * penalty.score(W[m])
        traces[m].append((len(traces[m]), Ffin, None, None, "current", W[m].copy()))
        out.append(FitResult(W[m], Ffin, status[m], traces[m], getattr(ev, "jobs", 0)))
    return out
