"""Softmax evaluations from expansions: as exact as scans, few scans a fit, and scans wherever the bound doesn't hold."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeway.functions.losses import get_loss
from ridgeway.operators import blocks as bl
from ridgeway.operators import expansion as ex
from ridgeway.operators import loss_grad as lg
from ridgeway.plans import params as P
from ridgeway.plans.catalog import QUERIES
from ridgeway.plans.catalog.evaluation import SOLVERS4, _four_solvers
from ridgeway.plans.catalog.fits import LAMBDA_MULTI
from ridgeway.sources import points as pt

SOFTMAX = get_loss("softmax")


def rows(n, seed=0, noise=1.0):
    """Features of lineitem's ranges and classes that hang on them."""
    rng = np.random.default_rng(seed)
    X = np.column_stack([rng.integers(1, 51, n) / 50, rng.uniform(0.01, 1.05, n), rng.integers(0, 11, n) / 10, rng.integers(0, 9, n) / 10])
    scores = X @ np.array([[2.0, -1.0, 0.5, 0.0], [-3.0, 2.0, 1.0, 1.0], [1.0, 2.0, 3.0, -2.0]]).T
    return X, np.argmax(scores + noise * rng.gumbel(size=(n, 3)), axis=1).astype(float)


def point_set(spark, X, y, n_classes=3):
    data = [(*map(float, x), int(t)) for x, t in zip(X, y)]
    schema = ", ".join(f"f{j} double" for j in range(X.shape[1])) + ", y int"
    df = spark.createDataFrame(data, schema).repartition(3)
    return pt.points_from_columns(df, [df[f"f{j}"] for j in range(X.shape[1])], df["y"], n_classes=n_classes)


def sums(X, y, W):
    losses, D = SOFTMAX.numpy(X @ W.T, y)
    return float(losses.sum()), D.T @ X


class Direct(lg.Evaluator):
    """The same sums in the test's own process."""

    def __init__(self, X, y, C):
        self.X, self.y, self.n_margins, self.d = X, y, C, X.shape[1]

    def evaluate(self, W):
        return (float(len(self.y)), *sums(self.X, self.y, np.asarray(W)))


def expanded(X, y, W, order):
    """A centre from rows in this process, in batches of odd sizes."""
    cuts = [0, 7, len(y) // 2, len(y)]
    read = lambda b: [(X[b[0] : b[1]], y[b[0] : b[1]])]
    (out,) = ex._partials(read, SOFTMAX, W, order)(list(zip(cuts, cuts[1:])))
    return ex._Centre(W, order, np.frombuffer(out.column("v")[0].as_py(), "<f8"))


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 4), st.integers(1, 5), st.integers(0, 10_000), st.floats(0.0, 1.0))
def test_answers_within_reach_are_those_of_a_scan(C, d, seed, part):
    rng = np.random.default_rng(seed)
    X, y = 2 * rng.random((60, d)) - 0.5, rng.integers(0, C, 60).astype(float)
    W = 2 * rng.standard_normal((C, d))
    order = ex.order_of(C, d)
    centre = expanded(X, y, W, order)
    u = rng.standard_normal((C, d))
    V = W + u * (part * centre.reach / ex.spread(u)) + rng.standard_normal((1, d))  # what all classes share changes no loss
    loss, grad = centre.at(V)
    want, want_grad = sums(X, y, V)
    assert centre.n == 60 and centre.reach > 0.0
    assert abs(loss - want) / 60 < 1e-14
    assert np.abs(grad - want_grad).max() / 60 < 2 * ex.GRADIENT_ERROR * np.linalg.norm(X, axis=1).mean()


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 4), st.integers(1, 4), st.integers(0, 10_000), st.floats(0.05, 1.5), st.integers(4, 8))
def test_what_an_expansion_leaves_out_is_within_its_bound(C, d, seed, size, order):
    """At moves far beyond the reach, where it is far above rounding."""
    rng = np.random.default_rng(seed)
    X, y = rng.standard_normal((50, d)), rng.integers(0, C, 50).astype(float)
    W, u = rng.standard_normal((C, d)), rng.standard_normal((C, d))
    D = size / np.linalg.norm(X, axis=1).max()
    V = W + u * (D / ex.spread(u))
    loss, grad = expanded(X, y, W, order).at(V)
    want, want_grad = sums(X, y, V)
    moment = (np.linalg.norm(X, axis=1) ** (order + 1)).sum()
    halves = np.linspace(0.5, 3.1, 105) / 2
    M = np.hypot(halves - np.log(np.cos(halves)), halves) / (2 * halves) ** (order + 1)
    B = math.sqrt(C) * np.exp(2 * halves) / np.cos(halves) / (2 * halves) ** order
    assert abs(loss - want) <= M.min() * D ** (order + 1) * moment + 1e-11
    assert np.linalg.norm(grad - want_grad) <= B.min() * D**order * moment + 1e-11


def test_orders_fit_the_sums_and_wide_problems_are_scanned():
    assert ex.order_of(3, 4) == ex.HIGHEST_ORDER
    assert ex.LOWEST_ORDER <= ex.order_of(3, 10) < ex.HIGHEST_ORDER
    assert ex.order_of(10, 64) is None
    assert ex.reach(3, 8, math.inf, 1.0) == ex.reach(3, 8, math.nan, 1.0) == 0.0


def test_near_weights_take_no_scan_and_far_ones_do(spark):
    X, y = rows(400)
    W = np.array([[0.5, -1.0, 0.2, 0.0], [0.0, 1.0, 0.3, -0.4], [1.0, 0.1, -0.7, 0.6]])
    with ex.ExpandedEvaluator(lg.SparkEvaluator(point_set(spark, X, y), "softmax")) as ev:
        move = np.random.default_rng(1).standard_normal((3, 4))
        near = [W + f * 0.02 * move / ex.spread(move) for f in (0.0, 0.3, 1.0)]
        n, losses, grads = ev.evaluate_many(near)
        assert (ev.jobs, n) == (1, 400.0) and 0.02 < ev.reach < 0.05
        far = W + move
        mixed = ev.evaluate_many([near[1], far])  # only the far one is scanned, and no centre is made there
        assert (ev.jobs, len(ev.centres)) == (2, 1)
        alone = ev.evaluate(W + 1.0)  # the same change of all classes
        assert ev.jobs == 2
        for V, l, g in [*zip(near, losses, grads), (near[1], mixed[1][0], mixed[2][0]), (far, mixed[1][1], mixed[2][1]),
                        (W + 1.0, alone[1], alone[2])]:
            want, want_grad = sums(X, y, V)
            assert l == pytest.approx(want, rel=1e-13)
            np.testing.assert_allclose(g, want_grad, atol=1e-10)
        broken = W.copy()
        broken[2, 3] = np.nan
        assert math.isnan(ev.evaluate(broken)[1]) and ev.jobs == 3
        ev.evaluate(far + 1e-4 * move)
        assert len(ev.centres) == 1  # far from the last weights
        ev.evaluate(far + 2e-4 * move)
        assert len(ev.centres) == 2  # close to them


def test_rows_that_have_no_bound_are_scanned(spark):
    X, y = rows(60)
    X[5, 1] = 1e60  # its ninth power is no double
    with ex.ExpandedEvaluator(lg.SparkEvaluator(point_set(spark, X, y), "softmax")) as ev:
        W = np.zeros((3, 4))
        for at in (W, W, W + 1e-70):
            n, loss, grad = ev.evaluate(at)
            want, want_grad = sums(X, y, at)
            assert n == 60 and loss == pytest.approx(want) and ev.centres == []
            np.testing.assert_allclose(grad, want_grad, rtol=1e-12, atol=1e-10)
        assert ev.jobs == 4  # one of them the attempt at a centre
    empty = point_set(spark, X, y)
    with pytest.raises(ValueError), ex.ExpandedEvaluator(lg.SparkEvaluator(empty.with_df(empty.df.limit(0)), "softmax")) as ev:
        ev.evaluate(W)
    with pytest.raises(Exception, match="class labels"), ex.ExpandedEvaluator(lg.SparkEvaluator(point_set(spark, X, y + 1), "softmax")) as ev:
        ev.evaluate(W)


def test_solver_comparison_multiclass_takes_few_scans(spark, tmp_path, monkeypatch):
    """All four fits take every step of theirs, with classes that hang on the features; most steps need no scan."""
    X, y = rows(300, seed=3)
    schema = "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    data = [(x[0] * 50, x[1] * 100000, x[2] / 10, x[3] / 10, "ANR"[int(t)]) for x, t in zip(X.tolist(), y)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    scans = []
    collect = bl.PointBlocks.collect
    monkeypatch.setattr(bl.PointBlocks, "collect", lambda self, run, size: scans.append(size) or collect(self, run, size))
    got = {(r.solver, r.class_id, r.feature_id): (r.weight, r.status)
           for r in QUERIES["solver_comparison_multiclass"](spark, str(tmp_path)).collect()}

    class Counted(Direct):
        calls = 0

        def evaluate_many(self, Ws, with_grad=True):
            self.calls += 1
            return super().evaluate_many(Ws, with_grad)

        def evaluate(self, W):
            self.calls += 1
            return super().evaluate(W)

    plain = Counted(X, y, 3)
    fits = _four_solvers(plain, np.ones((3, 4)), LAMBDA_MULTI, P.LR_MULTI)
    assert len(got) == 48 and set(SOLVERS4) == set(fits)
    for name, fit in fits.items():
        for c in range(3):
            for j in range(4):
                weight, status = got[name, c, j + 1]
                assert status == fit.status == "converged"
                assert weight == pytest.approx(fit.weights[c, j], abs=5.01e-4)
    assert np.ptp(fits["bfgs"].weights, axis=0).max() > 0.5  # far beyond one centre's reach
    assert plain.calls > 400 and len(scans) < plain.calls / 3


def test_fits_over_expansions_take_the_same_steps():
    X, y = rows(2000, seed=5)

    class InProcess(Direct):
        loss, jobs = SOFTMAX, 0

        @property
        def blocks(self):
            return self

        def matrices(self):
            return lambda b: [b]

        def collect(self, run, size):
            (out,) = run([(self.X, self.y)])
            return np.frombuffer(out.column("v")[0].as_py(), "<f8")

    a = _four_solvers(Direct(X, y, 3), np.ones((3, 4)), LAMBDA_MULTI, P.LR_MULTI)
    b = _four_solvers(ex.ExpandedEvaluator(InProcess(X, y, 3)), np.ones((3, 4)), LAMBDA_MULTI, P.LR_MULTI)
    for name in SOLVERS4:
        assert (a[name].iterations, a[name].status) == (b[name].iterations, b[name].status)
        np.testing.assert_allclose(b[name].path, a[name].path, atol=1e-11)
        np.testing.assert_allclose(b[name].train_log, a[name].train_log, atol=1e-13)
