"""Solvers without a d×d matrix: blocks of points, Lanczos, conjugate gradients, limited memory, dual ascent."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeway.operators import blocks as bl
from ridgeway.operators import loss_grad as lg
from ridgeway.operators import moments as mo
from ridgeway.operators import svm as sv
from ridgeway.operators.penalties import L2Penalty
from ridgeway.plans import trainers as tr
from ridgeway.session import checkpoint_dir
from ridgeway.sources import fixtures as fx
from ridgeway.sources import points as pt
from conftest import SF_SMALL


def table(spark, n, d, seed=0, parts=3, spread=True):
    rng = np.random.default_rng(seed)
    X = rng.standard_normal((n, d)) * (1.0 / (1 + np.arange(d) % 17) if spread else 1.0) / np.sqrt(d)
    y = np.where(X @ rng.standard_normal(d) + 0.1 * rng.standard_normal(n) > 0, 1.0, -1.0)
    rows = [(i, [float(v) for v in X[i]], float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y double").repartition(parts, "id")
    return pt.points_from_vectors(df, "v", "y", d, id="id"), X, y


def test_blocks_hold_every_row_and_sum_alike(spark):
    points, X, y = table(spark, 500, 64)
    with bl.PointBlocks(points) as b:
        n, xty, yty = b.label_product()
        assert (n, yty) == (500, pytest.approx(y @ y))
        np.testing.assert_allclose(xty, X.T @ y, atol=1e-12)
        V = np.random.default_rng(1).standard_normal((64, 3))
        np.testing.assert_allclose(b.gram_product(V), X.T @ (X @ V), atol=1e-12)
    w = np.linspace(-1, 1, 64)
    for loss in ("logistic", "hinge", "squared"):
        with lg.SparkEvaluator(points, loss) as a, lg.SparkEvaluator(points, loss, strategy="arrow") as c:
            assert a.strategy == "blocks"
            for got, want in zip(a.evaluate(w), c.evaluate(w)):
                np.testing.assert_allclose(got, want, rtol=1e-12, atol=1e-12)
    with pytest.raises(ValueError), lg.SparkEvaluator(points.with_df(points.df.limit(0)), "logistic") as ev:
        ev.evaluate(w)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(0, 1000))
def test_lanczos_and_conjugate_gradient(d, seed):
    rng = np.random.default_rng(seed)
    B = rng.standard_normal((d, rng.integers(1, 40)))
    A = B @ B.T
    assert bl.lanczos_largest(lambda v: A @ v, d) == pytest.approx(np.linalg.eigvalsh(A)[-1], rel=1e-8)
    b = rng.standard_normal(d)
    w, _ = bl.conjugate_gradient(lambda p: A @ p + p, b)
    np.testing.assert_allclose(w, np.linalg.solve(A + np.eye(d), b), atol=1e-6)
    assert bl.lanczos_largest(lambda v: 0 * v, d) == 0.0


def test_eigenvalue_and_ridge_agree_with_the_moments(spark):
    points, X, y = table(spark, 300, 64)
    m = mo.collect_moments(points)
    assert bl.largest_gram_eigenvalue(points) == pytest.approx(mo.lipschitz_constant(m), rel=1e-6)
    points, X, y = table(spark, 200, 50)
    w, steps = bl.ridge(points, 0.3)
    np.testing.assert_allclose(w, mo.ridge_closed_form(mo.collect_moments(points), 0.3), atol=1e-8)
    assert steps <= 60


def test_three_thousand_features(spark):
    points, X, y = table(spark, 60, 3000)
    assert mo.largest_eigenvalue(points, "sum") == pytest.approx(np.linalg.norm(X, 2) ** 2, rel=1e-6)
    w = mo.fit_ridge(points, 0.5)
    np.testing.assert_allclose(w, X.T @ np.linalg.solve(X @ X.T + 0.5 * np.eye(60), y), atol=1e-7)
    assert sv.svm_lipschitz_constant(points, 2.0) == pytest.approx(np.linalg.norm(X, 2) ** 2 / 4.0, rel=1e-6)
    with lg.SparkEvaluator(points, "squared") as ev:
        res = tr.bfgs(ev, np.zeros(3000), L2Penalty(), 0.05, tol=1e-5, keep_path=False)
    # mean squared loss and lam * score: the same problem as ridge with the matching weight
    lam = 60 * 0.05 * 2 * L2Penalty().score(np.eye(1)[0])
    np.testing.assert_allclose(res.weights, X.T @ np.linalg.solve(X @ X.T + lam * np.eye(60), y), atol=1e-3)
    assert res.status == "converged"


def test_limited_memory_is_the_dense_method_until_it_forgets(spark):
    points, X, y = table(spark, 400, 12, spread=False)
    with lg.SparkEvaluator(points, "logistic") as ev:
        dense = tr.bfgs(ev, np.zeros(12), L2Penalty(), 0.01)
        whole = tr.bfgs(ev, np.zeros(12), L2Penalty(), 0.01, memory=500)
        short = tr.bfgs(ev, np.zeros(12), L2Penalty(), 0.01, memory=4)
    assert dense.status == whole.status == short.status == "converged"
    np.testing.assert_allclose(whole.path, dense.path, atol=1e-6)
    np.testing.assert_allclose(short.weights, dense.weights, atol=1e-4)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 8), st.integers(1, 12), st.integers(0, 100))
def test_two_loops_are_the_matrix_product(d, k, seed):
    rng = np.random.default_rng(seed)
    A = rng.standard_normal((d, d))
    A = A @ A.T + np.eye(d)
    dense, limited = tr.DenseInverse(d), tr.LimitedInverse(50)
    for _ in range(k):
        s = rng.standard_normal(d)
        y = A @ s
        dense.update(s, y, float(s @ y))
        limited.update(s, y, float(s @ y))
    g = rng.standard_normal(d)
    np.testing.assert_allclose(limited.times(g), dense.times(g), rtol=1e-6, atol=1e-8)


@pytest.mark.parametrize("width", [1, 7, 65, 100])
def test_gram_blocks(spark, width):
    points, X, y = table(spark, 90, 64, parts=5)
    V = np.c_[y, X]
    blocks = mo.gram_blocks(points, width)
    assert all(len(r.block) <= 8 * width * width for r in blocks.collect())
    got = {(r.i, r.j): (r.value, r.n) for r in mo.moments_from_blocks(blocks, 64, width).collect()}
    assert len(got) == 65 * 65 and {n for _, n in got.values()} == {90}
    want = V.T @ V
    assert max(abs(v - want[k]) for k, (v, _) in got.items()) < 1e-10


def test_moments_of_five_thousand_features(spark):
    points, X, y = table(spark, 8, 5000)
    V = np.c_[y, X]
    rows = mo.moments_frame(points).where("i in (0, 1700, 5000) and j in (0, 1023, 1024, 4999)").collect()
    assert len(rows) == 12
    assert all(r.value == pytest.approx(V[:, r.i] @ V[:, r.j], abs=1e-12) and r.n == 8 for r in rows)


def scratch_tables(spark):
    folder = checkpoint_dir(spark).removeprefix("file:") + "/tables"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("partition_bytes,gap_tol", [(1 << 26, 1e-8), (40_000, 1e-4)])
def test_dual_ascent(spark, partition_bytes, gap_tol, monkeypatch):
    """One partition, and several whose changes are added: the projected gradient's model, a closed gap, nothing left behind."""
    monkeypatch.setattr(sv, "BLOCK_ROWS", 64)
    points, X, y = table(spark, 600, 10, parts=4, spread=False)
    before = scratch_tables(spark)
    fit = sv.fit_svm_ascent(points, 1.5, gap_tol=gap_tol, partition_bytes=partition_bytes)
    assert fit.status == "converged"
    assert fit.jobs < 20 or partition_bytes < 1 << 20  # one partition solves its rows alone
    assert len([t for t in scratch_tables(spark) - before if not t.startswith("multipliers")]) == 0
    assert all(b >= a - 1e-9 for a, b in zip(fit.dual_hist, fit.dual_hist[1:]))
    a = {r.id: r.a for r in fit.multipliers.collect()}
    assert len(a) == 600 and min(a.values()) >= 0 and max(a.values()) <= 1
    w = X.T @ (np.array([a[i] for i in range(600)]) * y) / 3.0
    np.testing.assert_allclose(w, fit.weights, atol=1e-9)
    primal = np.maximum(0, 1 - y * (X @ w)).sum() + 1.5 * w @ w
    assert primal - fit.dual_hist[-1] <= 1.01 * gap_tol * max(1.0, primal)
    # the projected gradient on the same dual, whole in memory
    yx, dual = X * y[:, None], np.zeros(600)
    step = 3.0 / np.linalg.norm(yx, 2) ** 2
    for _ in range(20_000):
        dual = np.clip(dual - step * (yx @ (yx.T @ dual) / 3.0 - 1.0), 0.0, 1.0)
    np.testing.assert_allclose(fit.weights, yx.T @ dual / 3.0, atol=1e-4 if gap_tol < 1e-6 else 0.2)


def test_dual_ascent_edge_cases(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], 1.0), (2, [1.0, 0.0], -1.0)], "id long, v array<double>, y double")
    points = pt.points_from_vectors(df, "v", "y", 2, id="id")
    fit = sv.fit_svm_ascent(points, 0.5)
    assert {r.id: round(r.a, 6) for r in fit.multipliers.collect()} == {1: 1.0, 2: 1.0} and fit.weights.tolist() == [-1.0, 0.0]
    with pytest.raises(ValueError):
        sv.fit_svm_ascent(points.with_df(points.df.limit(0)), 0.5)
    before = scratch_tables(spark)
    sv.fit_svm_dual(points, 0.5, n_iter=3)
    assert not [t for t in scratch_tables(spark) - before if t.startswith("blocks")]
    assert fx.svm_points(spark, SF_SMALL).id


@pytest.mark.parametrize("decay,grams", [(False, True), (True, True), (False, False)])
def test_projected_dual_takes_many_steps_a_job(spark, decay, grams, monkeypatch):
    """Every iterate is that of the plain iteration; without Gram matrices a job takes one step."""
    monkeypatch.setattr(sv, "BLOCK_ROWS", 64)
    if not grams:
        monkeypatch.setattr(sv, "GRAM_NUMBERS", 0)
    points, X, y = table(spark, 600, 10, parts=4, spread=False)
    yx = X * y[:, None]
    lr = 3.0 / np.linalg.norm(yx, 2) ** 2
    fit = sv.fit_svm_dual(points, 1.5, lr=lr, lr_decay=decay, n_iter=900 if grams else 12)
    a, path, duals, norms = np.zeros(600), [np.zeros(10)], [0.0], []
    for t in range(len(fit.eta_hist)):
        new = np.clip(a - lr / (np.sqrt(t + 1) if decay else 1.0) * (yx @ (yx.T @ a) / 3.0 - 1.0), 0.0, 1.0)
        norms.append(np.linalg.norm(new - a))
        a, v = new, yx.T @ new
        path.append(v / 3.0)
        duals.append(new.sum() - v @ v / 6.0)
    np.testing.assert_allclose(fit.weight_path, path, atol=1e-9)
    np.testing.assert_allclose(fit.dual_hist, duals, atol=1e-8)
    np.testing.assert_allclose(fit.norm_hist, norms, atol=1e-9)
    assert fit.status == ("converged" if norms[-1] < 1e-6 else "max_iter") and min(norms[:-1]) >= 1e-6
    got = {r.id: r.a for r in fit.multipliers.collect()}
    np.testing.assert_allclose([got[i] for i in range(600)], a, atol=1e-9)
    if grams:
        assert len(norms) > 300 and fit.jobs < len(norms) / 4


def test_projected_dual_guesses_rows_that_cross_a_bound(spark):
    """Windows grow while rows still reach and leave the box: far fewer jobs than steps, the same iterates."""
    points, X, y = table(spark, 3000, 10, parts=4, spread=False)
    yx = X * y[:, None]
    lr = 3.0 / np.linalg.norm(yx, 2) ** 2
    fit = sv.fit_svm_dual(points, 1.5, lr=lr, n_iter=1500)
    a, path, crossings, inside = np.zeros(3000), [np.zeros(10)], 0, None
    for _ in range(1500):
        a = np.clip(a - lr * (yx @ (yx.T @ a) / 3.0 - 1.0), 0.0, 1.0)
        path.append(yx.T @ a / 3.0)
        crossings += 0 if inside is None else int((inside != ((a > 0) & (a < 1))).sum())
        inside = (a > 0) & (a < 1)
    np.testing.assert_allclose(fit.weight_path, path, atol=1e-9)
    got = {r.id: r.a for r in fit.multipliers.collect()}
    np.testing.assert_allclose([got[i] for i in range(3000)], a, atol=1e-9)
    assert crossings > 1000 and fit.jobs < 50


def test_primal_history_reads_cached_blocks(spark, monkeypatch):
    """All iterates are scored over blocks packed once, without derivatives; nothing stays cached."""
    from ridgeway.functions.losses import get_loss
    from ridgeway.operators import loss_grad as lg

    monkeypatch.setattr(lg, "MAX_MARGINS_PER_ROW", 3)
    monkeypatch.setattr(lg, "_models_parts", None)  # scoring that reads and packs the points for each chunk
    points, X, y = table(spark, 200, 6, parts=2)
    path = [np.full(6, 0.3 * t) for t in range(8)]
    fit = sv.SVMFit(1.5, None, path[-1], [0.0] * 8, path, [])
    want = [np.maximum(0.0, 1.0 - y * (X @ w)).sum() + 1.5 * (w @ w) for w in path]
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    np.testing.assert_allclose(sv.primal_history(points, fit), want, atol=1e-9)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= kept
    hinge, Z = get_loss("hinge"), X @ np.array(path).T
    np.testing.assert_allclose(hinge.numpy_many_sums(Z, y), hinge.numpy_many(Z, y)[0].sum(axis=0), atol=1e-9)


def test_blocks_reach_workers_in_small_batches(spark, monkeypatch):
    """A pass over blocks hands over few of them at a time, whatever the session's batch size, which stays as it was."""
    monkeypatch.setattr(bl, "MOST_ROWS", 8)
    monkeypatch.setattr(bl, "BATCH_BYTES", 4 * 8 * 8 * 5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    points, X, y = table(spark, 600, 5, parts=2)

    def largest(batches):
        yield bl.packed([max(b.num_rows for b in batches)])

    with bl.PointBlocks(points) as b:
        assert 2 <= b.collect(largest, 1)[0] <= 4 * 2
        assert b.label_product()[0] == 600
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("loss", ["logistic", "softmax"])
def test_losses_of_far_margins(loss):
    from ridgeway.functions.losses import get_loss

    z = np.array([-800.0, -40.0, -1.0, -1e-9, 0.0, 0.5, 40.0, 800.0])
    for label in (0.0, 1.0):
        if loss == "logistic":
            y = np.full(8, 2.0 * label - 1.0)
            got, d = get_loss(loss).numpy(z[:, None], y)
            d = d[:, 0] * y
        else:
            y = np.full(8, label)
            got, d = get_loss(loss).numpy(np.column_stack([np.zeros(8), z]), y)
            assert np.allclose(d.sum(axis=1), 0.0, atol=1e-15) and d.shape == (8, 2)
            d = d[:, int(label)]
        m = z if label else -z
        np.testing.assert_allclose(got, np.logaddexp(0.0, -m), rtol=1e-14, atol=1e-15)
        np.testing.assert_allclose(d, -np.exp(-np.logaddexp(0.0, m)), rtol=1e-13, atol=1e-15)
