"""Softmax evaluations from a Taylor expansion of the whole table's loss, as exact as a scan's rounding.

With ``p`` a row's class probabilities at a centre W0 and ``v_c = (Δ_c − Δ_0)·x``
the change of its margins against class 0 at W0 + Δ, the row's loss changes by
``v_0 − v_y + log(1 + Σ_c p_c (e^{v_c} − 1))``. The logarithm's Taylor terms are
polynomials in p times monomials of v, and those are polynomials in x, so the terms
of the table's loss up to an order K need sums of (polynomial in p) × (monomial of x)
only: one scan, and a vector whose size depends on classes and features alone.

What is left out is bounded, not guessed. A row's margins change by a range
``R <= D ‖x‖`` over the classes, D being the largest ‖Δ_c − Δ_c'‖. For complex t with
``|t| <= ρ/R``, ρ < π, ``E_p[e^{t v}]`` has no zero, so by Cauchy's estimate, at any
point of the way from W0 to W0 + Δ, the loss's term of order K + 1 is at most
``M(ρ) (R/ρ)^{K+1}`` and the probabilities' term of order K at most
``e^ρ / cos(ρ/2) (R/ρ)^K``. Summed over the rows both hang on Σ ‖x‖^{K+1}, which the
scan takes along. Weights whose bounds aren't below ``LOSS_ERROR`` and
``GRADIENT_ERROR`` are evaluated by a scan.
"""

from __future__ import annotations

import math
from functools import cache
from itertools import accumulate, combinations_with_replacement

import numpy as np

from .loss_grad import Evaluator, SparkEvaluator

LOSS_ERROR = 1e-15  # of the mean loss
GRADIENT_ERROR = 1e-13  # of the mean gradient, as a part of the rows' mean norm
HIGHEST_ORDER, LOWEST_ORDER = 8, 4
MOST_SUMS = 10_000  # sums of one expansion; wider problems take a lower order, or scans only
PIECE_ROWS = 1024  # rows whose monomials are held at once
SCANS_EACH = 8  # what an expansion costs in plain scans
MOST_CENTRES = 32


class _Monomials:
    """Monomials of each degree 0..K in n variables, ordered by their largest variable.

    The monomials without a variable above j are a prefix of their degree, and
    those of the next degree with largest variable j are that prefix times x_j.
    """

    def __init__(self, n: int, order: int):
        self.n, self.order = n, order
        self.powers = [sorted(combinations_with_replacement(range(n), k), key=lambda m: m[::-1]) for k in range(order + 1)]
        self.places = [{m: i for i, m in enumerate(each)} for each in self.powers]
        self.prefix = [[sum(not m or m[-1] <= j for m in each) for j in range(n)] for each in self.powers]
        # raised[k][j][i]: the place in degree k + 1 of the i-th monomial of degree k times x_j
        self.raised = [
            np.array([[self.places[k + 1][tuple(sorted((*m, j)))] for m in self.powers[k]] for j in range(n)], dtype=int)
            for k in range(order)
        ]

    def size(self, k: int) -> int:
        return len(self.powers[k])

    def degrees(self) -> list[slice]:
        """Where the monomials of degree 1..K are among all of these."""
        ends = list(accumulate(self.size(k) for k in range(1, self.order + 1)))
        return [slice(a, b) for a, b in zip([0, *ends], ends)]

    def buffer(self, rows: int) -> np.ndarray:
        return np.empty((sum(self.size(k) for k in range(1, self.order + 1)), rows))

    def values(self, X: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Values of the monomials of degree 1..K at X, a (variables, rows) matrix, in rows of ``out``."""
        out[: self.n] = X
        start, at = 0, self.n
        for k in range(1, self.order):
            for j, width in enumerate(self.prefix[k]):
                np.multiply(out[start : start + width], X[j], out=out[at : at + width])
                at += width
            start += self.size(k)
        return out

    def times_linear(self, k: int, poly: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Coefficients of degree k + 1 of a polynomial of degree k times a·x."""
        out = np.zeros(self.size(k + 1))
        for j in range(self.n):
            out[self.raised[k][j]] += poly * a[j]  # the places of one j differ
        return out


@cache
def _monomials(n: int, order: int) -> _Monomials:
    return _Monomials(n, order)


@cache
def _log_terms(n: int, order: int) -> np.ndarray:
    """The matrix that gives the Taylor coefficients of log(1 + Σ_c p_c (e^{v_c} − 1)) at the monomials of v from
    those of p, both of degrees 1..order in the order of ``_monomials``."""
    mono = _monomials(n, order)
    exponents = [tuple(m.count(c) for c in range(n)) for each in mono.powers[1:] for m in each]
    places = {e: i for i, e in enumerate(exponents)}
    # s = Σ_c Σ_k p_c v_c^k / k!, as {(powers of v, powers of p): coefficient}
    unit = [tuple(int(c == e) for e in range(n)) for c in range(n)]
    s = {(tuple(k * u for u in unit[c]), unit[c]): 1.0 / math.factorial(k) for c in range(n) for k in range(1, order + 1)}
    power, log = {((0,) * n, (0,) * n): 1.0}, {}
    for j in range(1, order + 1):
        nxt: dict = {}
        for (v, p), a in power.items():
            for (w, q), b in s.items():
                if sum(v) + sum(w) <= order:
                    key = (tuple(map(sum, zip(v, w))), tuple(map(sum, zip(p, q))))
                    nxt[key] = nxt.get(key, 0.0) + a * b
        power = nxt
        for key, a in power.items():
            log[key] = log.get(key, 0.0) + (a if j % 2 else -a) / j
    out = np.zeros((len(places), len(places)))
    for (v, p), a in log.items():
        out[places[v], places[p]] = a
    return out


def order_of(classes: int, d: int) -> int | None:
    """The highest order whose sums stay within ``MOST_SUMS``; None where even the lowest one's don't."""
    total = 0
    best = None
    for k in range(1, HIGHEST_ORDER + 1):
        total += math.comb(k + classes - 2, k) * math.comb(k + d - 1, k)
        if total > MOST_SUMS:
            break
        best = k
    return best if best is not None and best >= LOWEST_ORDER else None


def reach(classes: int, order: int, moment: float, norm: float) -> float:
    """The largest D within both errors, for rows whose mean ‖x‖^(order + 1) is ``moment`` and mean norm ``norm``."""
    if not (0.0 < moment < math.inf and 0.0 < norm < math.inf):
        return 0.0
    best_loss = best_gradient = 0.0
    for rho in np.linspace(0.5, 3.1, 105):
        half = rho / 2
        M = math.hypot(half - math.log(math.cos(half)), half)
        best_loss = max(best_loss, rho * (LOSS_ERROR / (M * moment)) ** (1 / (order + 1)))
        B = math.sqrt(classes) * math.exp(rho) / math.cos(half)
        best_gradient = max(best_gradient, rho * (GRADIENT_ERROR * norm / (B * moment)) ** (1 / order))
    return min(best_loss, best_gradient)


def spread(delta: np.ndarray) -> float:
    """The largest ‖Δ_c − Δ_c'‖ between two classes; not a number if an entry isn't."""
    between = delta[:, None, :] - delta[None, :, :]
    return float(np.sqrt((between * between).sum(axis=2)).max())


def _partials(read, loss, W: np.ndarray, order: int):
    """Per-task sums: n, loss, norm, ‖x‖^(order + 1), features by class (C × d), then the terms degree by degree."""
    from .tree_sum import packed

    C, d = W.shape

    def run(batches):
        in_p, in_x, terms = _monomials(C - 1, order), _monomials(d, order), _log_terms(C - 1, order)
        buffers = [in_p.buffer(PIECE_ROWS), in_x.buffer(PIECE_ROWS)]
        degrees = list(zip(in_p.degrees(), in_x.degrees()))
        head, by_class = np.zeros(4), np.zeros((C, d))
        sums = [np.zeros((a.stop - a.start, b.stop - b.start)) for a, b in degrees]
        for X, y in (pair for b in batches for pair in read(b)):
            for at in range(0, len(y), PIECE_ROWS):
                x, t = X[at : at + PIECE_ROWS], y[at : at + PIECE_ROWS]
                losses, D = loss.numpy(x @ W.T, t)
                p = np.array(D.T, order="C")
                p[t.astype(np.int64), np.arange(len(t))] += 1.0
                norms = np.sqrt(np.einsum("ij,ij->i", x, x))
                with np.errstate(over="ignore"):  # then the centre has no reach
                    head += len(t), losses.sum(), norms.sum(), (norms ** (order + 1)).sum()
                for c in range(C):
                    by_class[c] += (t == c) @ x
                ps, xs = (b[:, : len(t)] for b in buffers)
                with np.errstate(over="ignore", invalid="ignore"):
                    coefficients = terms @ in_p.values(p[1:], ps)
                    in_x.values(np.ascontiguousarray(x.T), xs)
                    for total, (a, b) in zip(sums, degrees):
                        total += coefficients[a] @ xs[b].T
        if head[0]:
            yield packed(np.concatenate([head, by_class.reshape(-1), *(s.reshape(-1) for s in sums)]))

    return run


class _Centre:
    """An expansion about W: loss and gradient sums near it without a scan."""

    def __init__(self, W: np.ndarray, order: int, v: np.ndarray):
        C, d = W.shape
        self.W, self.order = W.copy(), order
        self.n, self.loss, norm, moment = v[:4]
        self.by_class = v[4 : 4 + C * d].reshape(C, d)
        self.in_v, self.in_x = _monomials(C - 1, order), _monomials(d, order)
        self.sums, at = [None], 4 + C * d
        for k in range(1, order + 1):
            size = self.in_v.size(k) * self.in_x.size(k)
            self.sums.append(v[at : at + size].reshape(self.in_v.size(k), -1))
            at += size
        finite = bool(np.isfinite(v).all()) and self.n > 0
        self.reach = reach(C, order, moment / self.n, norm / self.n) if finite else 0.0

    def at(self, W: np.ndarray) -> tuple[float, np.ndarray]:
        """(loss sum, gradient sums) at W."""
        C, d = W.shape
        move = (W - self.W)[1:] - (W - self.W)[0]
        loss, grad = self.loss - float((move * self.by_class[1:]).sum()), -self.by_class[1:]
        polys = [np.ones((1, 1))]  # per degree, the coefficients in x of each monomial of v
        for k in range(1, self.order + 1):
            level = np.empty((self.in_v.size(k), self.in_x.size(k)))
            for i, m in enumerate(self.in_v.powers[k]):
                level[i] = self.in_x.times_linear(k - 1, polys[-1][self.in_v.places[k - 1][m[:-1]]], move[m[-1]])
                for c in set(m):  # the derivative of this monomial by v_c is another one, of one degree less, times x
                    rest = list(m)
                    rest.remove(c)
                    lower = polys[-1][self.in_v.places[k - 1][tuple(rest)]]
                    grad[c] += m.count(c) * (self.sums[k][i][self.in_x.raised[k - 1]] @ lower)
            loss += float((level * self.sums[k]).sum())
            polys.append(level)
        return loss, np.vstack([-grad.sum(axis=0), grad])


class ExpandedEvaluator(Evaluator):
    """A softmax ``SparkEvaluator`` whose answers come from expansions wherever those are exact to rounding.

    The first weights asked for become a centre. Weights out of every centre's
    reach are scanned; where the calls come to move so little that a centre
    pays for itself (``SCANS_EACH`` moves stay within its reach), the scan makes
    one. The last ``MOST_CENTRES`` are kept, for all fits that share the evaluator.
    """

    def __init__(self, inner: SparkEvaluator):
        if inner.loss.name != "softmax" or inner.blocks is None:
            raise ValueError("expansions need the softmax loss over cached blocks")
        self.inner, self.n_margins, self.d = inner, inner.n_margins, inner.d
        self.order = order_of(self.n_margins, self.d) if self.n_margins > 1 else None
        self.centres: list[_Centre] = []
        self.reach: float | None = None  # depends on the rows only, so it is that of every centre
        self._last: np.ndarray | None = None

    @property
    def jobs(self) -> int:
        return self.inner.jobs

    def _known(self, W: np.ndarray):
        for centre in reversed(self.centres):
            if spread(W - centre.W) <= centre.reach:  # false for weights that aren't finite
                return centre.at(W)
        return None

    def _expand(self, W: np.ndarray) -> None:
        C, d, inner = self.n_margins, self.d, self.inner
        mono = [_monomials(C - 1, self.order), _monomials(d, self.order)]
        size = 4 + C * d + sum(mono[0].size(k) * mono[1].size(k) for k in range(1, self.order + 1))
        inner.jobs += 1
        centre = _Centre(W, self.order, inner.blocks.collect(_partials(inner.blocks.matrices(), inner.loss, W, self.order), size))
        self.reach = centre.reach
        if centre.reach > 0.0:
            self.centres = [*self.centres[1 - MOST_CENTRES :], centre]

    def _pays(self, W: np.ndarray) -> bool:
        if self.order is None or not np.isfinite(W).all():
            return False
        return self.reach is None or 0.0 < self.reach >= SCANS_EACH * spread(W - self._last)

    def evaluate(self, W):
        n, losses, grads = self.evaluate_many(np.asarray(W, dtype=float).reshape(1, self.n_margins, self.d))
        return n, float(losses[0]), grads[0]

    def evaluate_many(self, Ws, with_grad=True):
        Ws = np.asarray(Ws, dtype=float).reshape(-1, self.n_margins, self.d)
        found = [self._known(W) for W in Ws]
        open_ = [k for k, f in enumerate(found) if f is None]
        if open_ and self._pays(Ws[open_[0]]):
            self._expand(Ws[open_[0]])
            for k in open_:
                found[k] = self._known(Ws[k])
            open_ = [k for k in open_ if found[k] is None]
        if len(Ws):
            self._last = Ws[0].copy()
        n = self.centres[-1].n if self.centres else 0.0
        losses = np.array([np.nan if f is None else f[0] for f in found])
        grads = np.array([np.zeros(Ws.shape[1:]) if f is None else f[1] for f in found])
        if open_:
            n, losses[open_], grads[open_] = self.inner.evaluate_many(Ws[open_], with_grad)
        return n, losses, grads

    def close(self) -> None:
        self.inner.close()
