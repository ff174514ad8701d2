"""Invariants of the operators and trainers (KKT, duality, monotonicity, hooks)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from ridgeway.operators import loss_grad as lg
from ridgeway.operators import moments as mo
from ridgeway.operators import penalties as pe
from ridgeway.operators import svm as sv
from ridgeway.plans import trainers as tr
from ridgeway.sources import fixtures as fx


def test_column_and_arrow_strategies_agree(spark):
    pts = fx.multi_points(spark, SF_SMALL)
    W = np.linspace(-0.5, 0.5, 12).reshape(3, 4)
    a = lg.SparkEvaluator(pts, "softmax", strategy="column")
    b = lg.SparkEvaluator(pts, "softmax", strategy="arrow")
    try:
        na, la, ga = a.evaluate(W)
        nb, lb, gb = b.evaluate(W)
    finally:
        a.close()
        b.close()
    assert na == nb == 6000 or na == nb
    assert la == pytest.approx(lb, rel=1e-12)
    np.testing.assert_allclose(ga, gb, rtol=1e-10, atol=1e-12)


def test_moments_evaluator_equals_row_evaluator(spark):
    pts = fx.reg_points(spark, SF_SMALL)
    w = np.array([0.3, -0.2, 0.1, 0.4])
    m = mo.MomentsEvaluator.from_points(pts)
    s = lg.SparkEvaluator(pts, "squared")
    try:
        n1, l1, g1 = m.evaluate(w)
        n2, l2, g2 = s.evaluate(w)
    finally:
        s.close()
    assert n1 == n2
    assert l1 == pytest.approx(l2, rel=1e-9)
    np.testing.assert_allclose(g1, g2, rtol=1e-9)


def test_wide_moments_use_arrow_and_match_numpy(spark):
    pts = fx.grp_points(spark, SF_SMALL)
    m = mo.collect_moments(pts)
    pdf = pts.df.select(*pts.features, pts.label).toPandas()
    X = pdf[list(pts.features)].to_numpy()
    np.testing.assert_allclose(m.xtx, X.T @ X, rtol=1e-10)
    np.testing.assert_allclose(m.xty, X.T @ pdf["label"].to_numpy(), rtol=1e-10)


def test_lasso_kkt(spark):
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_MID))
    lam = 0.05
    res = tr.proximal_gradient(ev, np.zeros(2), pe.L1Penalty(), lam, lr=1.0, lr_decay=False, n_iter=2000)
    n, _, G = ev.evaluate(res.weights)
    g = G[0] / n
    for wj, gj in zip(res.weights, g):
        if wj == 0:
            assert abs(gj) <= lam + 1e-5
        else:
            assert gj == pytest.approx(-lam * np.sign(wj), abs=1e-5)


def test_group_lasso_kkt_and_momentum_variants(spark):
    pts = fx.grp_points(spark, SF_SMALL)
    ev = mo.MomentsEvaluator.from_points(pts)
    groups = [list(range(8 * g, 8 * g + 8)) for g in range(8)]
    lam = 0.04
    pen = pe.GroupL1Penalty(groups)
    a = tr.accelerated_proximal(ev, np.zeros(65), pen, lam, lr=0.9, lr_decay=False, n_iter=5000)
    b = tr.accelerated_proximal(ev, np.zeros(65), pen, lam, lr=0.9, lr_decay=False, n_iter=20000, momentum="sqrt")
    assert a.status == b.status == "converged"
    np.testing.assert_allclose(a.weights, b.weights, atol=1e-2)
    zeroed = [not a.weights[g].any() for g in groups]
    assert any(zeroed) and not all(zeroed)
    n, _, G = ev.evaluate(a.weights)
    g = G[0] / n
    for grp in groups:
        wg = a.weights[grp]
        if np.linalg.norm(wg) == 0:
            assert np.linalg.norm(g[grp]) <= lam + 1e-4
        else:
            np.testing.assert_allclose(g[grp], -lam * wg / np.linalg.norm(wg), atol=1e-4)
    assert abs(g[64]) < 1e-4  # the free bias


def test_group_prox_thresholds_differ_on_edge():
    # one 2-feature group with λ < ‖v‖ ≤ λ√2
    v = np.array([0.6, 0.6])  # norm 0.8485
    t = 0.7
    exact = pe.GroupL1Penalty([[0, 1]]).prox(v, t)
    legacy = pe.GroupL1Penalty([[0, 1]], threshold="sqrt_size").prox(v, t)
    assert np.all(exact > 0)
    assert np.all(legacy == 0)


def test_prox_at_zero_is_identity():
    v = np.array([0.3, -1.2, 0.0, 2.5])
    for p in (pe.L2Penalty(), pe.L1Penalty(), pe.GroupL1Penalty([[0, 1], [2, 3]])):
        np.testing.assert_allclose(p.prox(v, 0.0), v)


def test_nondifferentiable_penalty_is_refused(spark):
    with pytest.raises(ValueError):
        pe.L1Penalty().grad(np.ones(2))
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_SMALL))
    with pytest.raises(ValueError):
        tr.gradient_descent(ev, np.zeros(2), pe.L1Penalty(), 0.1)
    with pytest.raises(ValueError):
        tr.bfgs(ev, np.zeros(2), pe.GroupL1Penalty([[0, 1]]), 0.1)


def test_argument_checks(spark):
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_SMALL))
    with pytest.raises(ValueError):
        tr.proximal_gradient(ev, np.zeros(2), n_iter=0)
    with pytest.raises(ValueError):
        tr.proximal_gradient(ev, np.zeros(2), tol=1e-9)
    with pytest.raises(ValueError):
        tr.proximal_gradient(ev, np.zeros(2), lr=0.0)


def test_armijo_descent_is_monotone_and_batch_invariant(spark):
    pts = fx.bin2_points(spark, SF_SMALL)
    ev = lg.SparkEvaluator(pts, "logistic")
    try:
        a = tr.gradient_descent(ev, np.zeros(2), pe.L2Penalty(), 0.01, lr=4.0, n_iter=8, batch=8)
        b = tr.gradient_descent(ev, np.zeros(2), pe.L2Penalty(), 0.01, lr=4.0, n_iter=8, batch=1)
    finally:
        ev.close()
    losses = [row[1] for row in a.trace]
    assert all(x >= y - 1e-12 for x, y in zip(losses, losses[1:]))
    np.testing.assert_allclose([r[2] for r in a.trace[:-1]], [r[2] for r in b.trace[:-1]], rtol=1e-12)
    np.testing.assert_allclose(a.weights, b.weights, rtol=1e-9)


def test_bfgs_matches_spark_ml_logistic(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    pts = fx.bin2_points(spark, SF_MID)
    ev = lg.SparkEvaluator(pts, "logistic")
    try:
        res = tr.bfgs(ev, np.zeros(2), pe.L2Penalty(), 0.01, tol=1e-6)
    finally:
        ev.close()
    df = VectorAssembler(inputCols=list(pts.features), outputCol="features").transform(
        pts.df.withColumn("y01", (F.col("label") + 1) / 2)
    )
    ml = LogisticRegression(featuresCol="features", labelCol="y01", regParam=0.01, elasticNetParam=0.0,
                            fitIntercept=False, standardization=False, tol=1e-12, maxIter=200).fit(df)
    np.testing.assert_allclose(res.weights, ml.coefficients.toArray(), atol=1e-4)


def test_svm_dual_state_and_weak_duality(spark):
    pts = fx.svm_points(spark, SF_SMALL)
    fit = sv.fit_svm_dual(pts, 1.0, lr=0.05, lr_decay=False, n_iter=12, checkpoint_every=4)
    a = fit.multipliers.agg(F.min("a"), F.max("a"), F.count("a")).first()
    assert 0.0 <= a[0] <= a[1] <= 1.0
    assert a[2] == 500
    primal = sv.primal_history(pts, fit)
    assert all(p >= d - 1e-9 for p, d in zip(primal, fit.dual_hist))
    assert fit.dual_hist[-1] > fit.dual_hist[0]


def test_custom_optimizer_hook_equals_plain_gradient_step(spark):
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_SMALL))

    def step(w, state, data):
        _, g = data(w)
        state["eta"] = 0.5
        return w - 0.5 * g, state

    a = tr.custom_optimizer(ev, np.zeros(2), step, n_iter=25)
    b = tr.proximal_gradient(ev, np.zeros(2), None, 0.0, lr=0.5, lr_decay=False, n_iter=25)
    np.testing.assert_allclose(a.weights, b.weights, rtol=1e-12)
    assert len(a.trace) == len(b.trace)


def test_box_projector_and_custom_projection():
    p = pe.BoxProjector()
    assert p.contains(np.array([0.0, 0.5, 1.0]))
    assert not p.contains(np.array([-0.1, 0.5]))
    np.testing.assert_allclose(p.project(np.array([-1.0, 0.3, 2.0])), [0.0, 0.3, 1.0])


def test_empty_input_raises(spark):
    pts = fx.bin_points(spark, SF_SMALL)
    empty = pts.with_df(pts.df.where(F.lit(False)))
    ev = lg.SparkEvaluator(empty, "logistic")
    try:
        with pytest.raises(ValueError):
            ev.evaluate(np.zeros(4))
    finally:
        ev.close()


def test_trace_has_one_row_more_than_steps(spark):
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_SMALL))
    res = tr.proximal_gradient(ev, np.zeros(2), pe.L2Penalty(), 0.1, lr=1.0, lr_decay=False, n_iter=7)
    assert len(res.trace) == 8
    t = res.trace_frame(spark, "r")
    assert t.count() == 8


def test_checkpoint_dir_comes_from_session(spark):
    from ridgeway.session import checkpoint_dir

    assert "ridgeway-test-ckpt-" in checkpoint_dir(spark)


def test_model_stacks_beyond_one_job_run_in_chunks(spark, monkeypatch):
    pts = fx.bin2_points(spark, SF_SMALL)
    Ws = np.random.default_rng(0).normal(0, 1, (23, 2))
    n, losses, grads = lg.collect_models(pts, "logistic", Ws)
    monkeypatch.setattr(lg, "MAX_MARGINS_PER_ROW", 5)
    assert len(list(lg._chunks(Ws[:, None, :], True))) == 5
    n2, losses2, grads2 = lg.collect_models(pts, "logistic", Ws)
    frame = {r.model: r.loss_sum for r in lg.models_frame(pts, "logistic", Ws).collect()}
    assert n == n2 and sorted(frame) == list(range(23))
    np.testing.assert_allclose(losses, losses2, rtol=1e-12)
    np.testing.assert_allclose(losses, [frame[m] for m in range(23)], rtol=1e-12)
    np.testing.assert_allclose(grads, grads2, rtol=1e-9, atol=1e-9)


def test_svm_lipschitz_equals_kernel_eigenvalue(spark):
    pts = fx.svm_points(spark, SF_SMALL)
    lam = 1.0
    L = sv.svm_lipschitz_constant(pts, lam)
    pdf = pts.df.select(*pts.features, "label").toPandas()
    X = pdf[list(pts.features)].to_numpy()
    y = pdf["label"].to_numpy()
    K = (y[:, None] * X) @ (y[:, None] * X).T  # test-only: 500 x 500 on the driver
    assert L == pytest.approx(np.linalg.eigvalsh(K / (2 * lam)).max(), rel=1e-9)
    fit = sv.fit_svm_dual(pts, lam, lr="lipschitz", lr_decay=False, n_iter=30)
    assert fit.dual_hist[-1] >= fit.dual_hist[1]


def test_fit_api_dispatch_and_lasso_matches_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from ridgeway.plans.api import fit

    pts = fx.reg2_points(spark, SF_MID)
    res = fit(pts, "squared", pe.L1Penalty(), 0.05, solver="accelerated_proximal", lr=1.0, lr_decay=False,
              n_iter=3000)
    df = VectorAssembler(inputCols=list(pts.features), outputCol="features").transform(pts.df)
    ml = LinearRegression(featuresCol="features", labelCol="label", regParam=0.05, elasticNetParam=1.0,
                          fitIntercept=False, standardization=False, tol=1e-12, maxIter=500).fit(df)
    np.testing.assert_allclose(res.weights, ml.coefficients.toArray(), atol=1e-4)
    with pytest.raises(ValueError):
        fit(pts, "squared", solver="newton")


def test_softmax_bfgs_matches_spark_ml_multinomial(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from ridgeway.plans.api import fit

    pts = fx.rmulti_points(spark, SF_SMALL)
    res = fit(pts, "softmax", pe.L2Penalty(), 0.01, solver="bfgs", tol=1e-6)
    df = VectorAssembler(inputCols=list(pts.features), outputCol="features").transform(
        pts.df.withColumn("y", F.col("label").cast("double")))
    ml = LogisticRegression(featuresCol="features", labelCol="y", family="multinomial", regParam=0.01,
                            elasticNetParam=0.0, fitIntercept=False, standardization=False, tol=1e-12,
                            maxIter=500).fit(df)
    W = ml.coefficientMatrix.toArray()
    # the softmax is invariant to a common shift of the class rows; L2 picks the centred one
    np.testing.assert_allclose(res.weights, W, atol=2e-4)


def test_wide_long_form_goes_through_arrow_and_matches(spark):
    pts = fx.sm10_points(spark, SF_SMALL)  # vector points
    W = np.linspace(-0.3, 0.3, 640).reshape(10, 64)
    a = lg.loss_grad_long(pts, "softmax", W).orderBy("class_id", "feature_id").collect()
    with lg.SparkEvaluator(pts, "softmax", strategy="column") as ev:  # one column per element, in several aggregates
        n, lsum, G = ev._column_parts(W[None], True)
    assert len(a) == 640 and a[0]["n"] == n
    assert a[0]["loss"] == pytest.approx(lsum[0] / n, rel=1e-12)
    got = np.array([r["grad"] for r in a]).reshape(10, 64)
    np.testing.assert_allclose(got, G[0] / n, rtol=1e-9, atol=1e-12)


def test_svm_trace_frame(spark):
    pts = fx.svm_points(spark, SF_SMALL)
    fit = sv.fit_svm_dual(pts, 1.0, lr=0.05, lr_decay=False, n_iter=4)
    t = fit.trace_frame(spark, "svm").orderBy("iter").collect()
    assert len(t) == 5
    assert t[-1]["eta"] is None and t[0]["eta"] == 0.05
    assert [r["loss"] for r in t] == pytest.approx(fit.dual_hist)


def test_fit_result_path_and_log(spark):
    from ridgeway.plans.api import fit

    res = fit(fx.reg2_points(spark, SF_SMALL), "squared", pe.L2Penalty(), 0.1, solver="gradient_descent", n_iter=5)
    assert res.path.shape == (len(res.trace), 2)
    np.testing.assert_allclose(res.path[0], [0.0, 0.0])
    np.testing.assert_allclose(res.path[-1], res.weights)
    assert res.train_log[-1] == pytest.approx(res.objective)


def test_proximal_path_equals_separate_fits(spark):
    ev = lg.SparkEvaluator(fx.bin2_points(spark, SF_SMALL), "logistic")
    try:
        path = tr.proximal_path(ev, np.zeros(2), pe.L1Penalty(), [0.001, 0.02], lr=1.0, lr_decay=False, n_iter=6)
        solo = [tr.proximal_gradient(ev, np.zeros(2), pe.L1Penalty(), lam, lr=1.0, lr_decay=False, n_iter=6)
                for lam in (0.001, 0.02)]
    finally:
        ev.close()
    for a, b in zip(path, solo):
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-9, atol=1e-12)
        assert len(a.trace) == len(b.trace)


def test_bowl_lasso_batch_loss_meets_kkt(spark):
    from ridgeway.plans import catalog

    pts = fx.reg2_points(spark, SF_SMALL)
    m = mo.collect_moments(pts)
    A, mu = m.xtx / m.n, np.linalg.solve(m.xtx, m.xty)
    runs = {}
    for strategy in ("auto", "arrow"):  # the Column form (JVM) and the per-batch Python form
        with lg.SparkEvaluator(pts, catalog.bowl_loss(mu), strategy=strategy) as ev:
            runs[ev.strategy] = tr.proximal_path(ev, np.zeros(2), pe.L1Penalty(), catalog.BOWL_LAMBDAS,
                                                 lr=1.0 / mo.lipschitz_constant(m), lr_decay=False)
    assert set(runs) == {"column", "arrow"}
    for a, b in zip(runs["column"], runs["arrow"]):
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-9, atol=1e-12)
    fits = runs["column"]
    assert not fits[-1].weights.any() and fits[0].weights.all()
    for lam, f in zip(catalog.BOWL_LAMBDAS, fits):
        g = A @ (f.weights - mu)
        for wj, gj in zip(f.weights, g):
            if wj == 0:
                assert abs(gj) <= lam + 1e-4
            else:
                assert gj == pytest.approx(-lam * np.sign(wj), abs=1e-4)


def test_points_from_array_and_ml_vector(spark):
    from pyspark.ml.feature import VectorAssembler

    from ridgeway.sources.points import points_from_array
    from ridgeway.sources.tables import table

    em = table(spark, SF_SMALL, "embeddings")
    a = points_from_array(em, "embedding", F.col("label").cast("double"), 64, id="vec_id")
    b = fx.svm_points(spark, SF_SMALL)
    ra = a.df.orderBy("id").select("x1", "x4").collect()
    rb = b.df.orderBy("id").select("x1", "x4").collect()
    assert ra == rb
    vec = VectorAssembler(inputCols=["x1", "x2", "x3"], outputCol="v").transform(b.df)
    c = points_from_array(vec, "v", "label", 3, id="id")
    assert c.df.orderBy("id").select("x3").collect() == b.df.orderBy("id").select("x3").collect()
    for d in (63, 65):  # neither cut nor padded
        with pytest.raises(Exception, match=f"not of length {d}"):
            points_from_array(em, "embedding", F.lit(1.0), d).df.collect()


def test_bad_labels_fail_instead_of_dropping_out(spark):
    pts = fx.bin_points(spark, SF_SMALL)
    zero_one = pts.with_df(pts.df.withColumn("label", (F.col("label") + 1) / 2))
    with pytest.raises(Exception, match="labels -1 or \\+1"):
        lg.loss_grad_row(zero_one, "logistic", np.zeros(4)).collect()
    multi = fx.multi_points(spark, SF_SMALL)
    shifted = multi.with_df(multi.df.withColumn("label", F.col("label") + 1))
    with pytest.raises(Exception, match="class labels must lie"):
        lg.loss_grad_row(shifted, "softmax", np.zeros((3, 4))).collect()


def test_svm_duality_gap_closes_with_lipschitz_step(spark):
    pts = fx.svm_points(spark, SF_SMALL)
    fit = sv.fit_svm_dual(pts, 6.0)
    primal = sv.primal_history(pts, fit)
    gaps = [p - d for p, d in zip(primal, fit.dual_hist)]
    assert fit.status == "converged"
    assert all(g >= -1e-6 for g in gaps)  # weak duality along the path
    assert gaps[-1] < 1e-4 * gaps[0]


def test_empty_input_aggregate_gives_n_zero_and_null_loss(spark):
    pts = fx.bin_points(spark, SF_SMALL)
    empty = pts.with_df(pts.df.where(F.lit(False)))
    rows = lg.loss_grad_long(empty, "logistic", np.zeros(4)).collect()
    assert len(rows) == 4 and all(r["n"] == 0 and r["loss"] is None and r["grad"] is None for r in rows)


class _UphillEvaluator(lg.Evaluator):
    """f(w) = ½‖w‖² but reporting −∇f, so no Armijo step can ever be accepted."""

    n_margins, d, jobs = 1, 2, 0

    def evaluate(self, W):
        w = np.asarray(W, dtype=float).reshape(-1)
        return 1.0, 0.5 * float(w @ w), -w[None, :]


def test_line_search_gives_up_after_max_shrinks():
    res = tr.gradient_descent(_UphillEvaluator(), np.array([1.0, -2.0]), None, 0.0, max_shrinks=100)
    assert res.status == "line_search_failed"
    np.testing.assert_allclose(res.weights, [1.0, -2.0])
    assert len(res.trace) == 1


def test_keep_path_false_drops_iterates_but_keeps_result(spark):
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_SMALL))
    res = tr.proximal_gradient(ev, np.zeros(2), pe.L2Penalty(), 0.1, lr=1.0, lr_decay=False, n_iter=5,
                               keep_path=False)
    assert res.trace[-1][5] is not None and all(r[5] is None for r in res.trace[:-1])
    with pytest.raises(ValueError):
        res.path
    assert res.trace_frame(spark, "r").where(F.col("weights").isNull()).count() == len(res.trace) - 1


def test_matrix_solvers_lower_the_objective(spark):
    ev = lg.SparkEvaluator(fx.multi_points(spark, SF_SMALL), "softmax")
    W0 = np.ones((3, 4))
    try:
        F0 = tr.proximal_gradient(ev, W0, pe.L2Penalty(), 0.01, n_iter=1).trace[0][1]
        for f in (tr.gradient_descent, tr.bfgs):
            res = f(ev, W0, pe.L2Penalty(), 0.01, lr=1.0, n_iter=4)
            assert res.weights.shape == (3, 4)
            assert res.objective < F0
            losses = [r[1] for r in res.trace]
            assert all(a >= b - 1e-12 for a, b in zip(losses, losses[1:]))
    finally:
        ev.close()


def test_survey_check_values(spark):
    """Numbers recorded independently in FIXTURES.md (sf0.01)."""
    from ridgeway.plans import params as P

    pts = fx.bin_points(spark, SF_MID)
    pts = pts.with_df(pts.df.withColumn("x4", F.lit(1.0)))
    rows = lg.loss_grad_long(pts, "logistic", list(P.W_BIN)).orderBy("feature_id").collect()
    assert rows[0]["loss"] == pytest.approx(0.721168264, abs=1e-9)
    np.testing.assert_allclose([r["grad"] for r in rows], [0.104809301, 0.102260978, 0.106559570, 0.201843390],
                               atol=1e-9)
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_MID))
    # the exact lasso solution; the stop rule ‖Δw‖ < 1e-6 leaves the accelerated method ~2e-5 away
    lasso = tr.accelerated_proximal(ev, np.zeros(2), pe.L1Penalty(), 0.05, lr=1.0, lr_decay=False, n_iter=2000)
    np.testing.assert_allclose(lasso.weights, [0.377330, 0.359071], atol=5e-5)
    step = 1.0 / mo.lipschitz_constant(ev.m)
    ista = tr.proximal_gradient(ev, np.zeros(2), pe.L1Penalty(), 0.05, lr=step, lr_decay=False, n_iter=5000)
    np.testing.assert_allclose(ista.weights, [0.377330, 0.359071], atol=1e-5)
    ev2 = lg.SparkEvaluator(fx.bin2_points(spark, SF_MID), "logistic")
    try:
        ridge = tr.bfgs(ev2, np.zeros(2), pe.L2Penalty(), 0.01)
    finally:
        ev2.close()
    np.testing.assert_allclose(ridge.weights, [-0.56938, -0.53215], atol=1e-5)


def test_evaluator_context_manager_releases_cache(spark):
    pts = fx.bin2_points(spark, SF_SMALL)
    with lg.SparkEvaluator(pts, "logistic") as ev:
        ev.evaluate(np.zeros(2))
        assert (ev.blocks or ev.points).df.storageLevel.useMemory
    assert not (ev.blocks or ev.points).df.storageLevel.useMemory


def test_model_and_trace_sinks_round_trip(spark):
    from ridgeway.session import scratch_path
    from ridgeway.sources import sinks

    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, SF_SMALL))
    res = tr.proximal_gradient(ev, np.zeros(2), pe.L2Penalty(), 0.1, lr=1.0, lr_decay=False, n_iter=4)
    mpath = sinks.write_model(res.model_frame(spark, 7), scratch_path(spark, "model"))
    back = sinks.read_model(spark, mpath).orderBy("feature_id").collect()
    assert [r["model_id"] for r in back] == [7, 7]
    np.testing.assert_allclose([r["weight"] for r in back], res.weights)
    tpath = scratch_path(spark, "trace")
    sinks.write_trace(res.trace_frame(spark, "a"), tpath)
    sinks.write_trace(res.trace_frame(spark, "b"), tpath)  # appends
    t = sinks.read_trace(spark, tpath)
    assert t.count() == 2 * len(res.trace)
    assert sorted(r["run_id"] for r in t.select("run_id").distinct().collect()) == ["a", "b"]


def test_reference_quirk_flags_q1_q2_q4(spark):
    W = np.array([[1.0, -2.0], [0.5, 0.5]])
    assert pe.L2Penalty().score(W) == pytest.approx(0.5 * (1 + 4 + 0.25 + 0.25))
    assert pe.L2Penalty("column_sums").score(W) == pytest.approx(0.5 * ((-1.0) ** 2 + 1.0 ** 2))
    assert pe.L2Penalty("column_sums").score(W[0]) == pe.L2Penalty().score(W[0])  # vectors agree
    G = np.array([[1.0, 2.0], [3.0, -1.0]])
    assert tr.armijo_slope(G, -G) == pytest.approx(-(1 + 4 + 9 + 1))
    assert tr.armijo_slope(G, -G, "sum_of_products") == pytest.approx(-((G.T @ G).sum()))
    ev = lg.SparkEvaluator(fx.multi_points(spark, SF_SMALL), "softmax")
    try:
        a = tr.bfgs(ev, np.ones((3, 4)), pe.L2Penalty(), 0.01, n_iter=3)
        b = tr.bfgs(ev, np.ones((3, 4)), pe.L2Penalty(), 0.01, n_iter=3, curvature="data")
        c = tr.gradient_descent(ev, np.ones((3, 4)), pe.L2Penalty("column_sums"), 0.01, n_iter=3,
                                slope="sum_of_products")
    finally:
        ev.close()
    assert not np.allclose(a.weights, b.weights)  # the flag changes the iterates
    # at W = ones(3, 4): ½Σ_c(Σ_j w)² = 24 against ½‖W‖² = 6, so the logged objectives differ by λ·18
    assert c.trace[0][1] - a.trace[0][1] == pytest.approx(0.01 * 18)


def test_partial_sums_go_through_one_packed_row_per_task(spark):
    pts = fx.sm10_points(spark, SF_SMALL)
    for df in (lg.models_frame(pts, "softmax", np.zeros((3, 10, 64))), mo.moments_frame(fx.grp_points(spark, SF_SMALL))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce" not in plan and "RoundRobin" not in plan
        assert "hashpartitioning(part" in plan
    parts = lg._models_parts(pts, "softmax", np.zeros((3, 10, 64)), True)
    assert parts.count() <= parts.rdd.getNumPartitions()


def test_column_only_losses_work_at_any_width(spark):
    from ridgeway.functions.losses import CustomLoss

    absolute = CustomLoss("smooth", lambda z, y: (F.sqrt((z - y) * (z - y) + 1.0), (z - y) / F.sqrt((z - y) * (z - y) + 1.0)))
    with lg.SparkEvaluator(fx.reg_points(spark, SF_SMALL), absolute) as ev:
        res = tr.gradient_descent(ev, np.zeros(4), pe.L2Penalty(), 0.01, lr=1e3, n_iter=3)  # a long line search
        assert res.status in ("max_iter", "converged") and res.iterations > 0
    with lg.SparkEvaluator(fx.grp_points(spark, SF_SMALL), absolute) as ev:  # 65 features, then two models
        n, losses, grads = ev.evaluate_many(np.zeros((2, 65)))
        assert n == 500 and np.isfinite(grads).all() and losses[0] == losses[1]


def test_empty_and_unfinished_inputs_are_errors_or_say_so(spark):
    pts = fx.svm_points(spark, SF_SMALL)
    empty = pts.with_df(pts.df.where(F.lit(False)))
    with pytest.raises(ValueError, match="empty"):
        sv.fit_svm_dual(empty, 1.0, lr=0.1)
    with pytest.raises(ValueError, match="empty"), lg.SparkEvaluator(empty, "logistic") as ev:
        tr.proximal_path(ev, np.zeros(64), pe.L1Penalty(), [0.1])
    zero_one = pts.with_df(pts.df.withColumn("label", (F.col("label") + 1) / 2))
    with pytest.raises(Exception, match="labels -1 or"):
        sv.fit_svm_dual(zero_one, 1.0, lr=0.1)
    with pytest.raises(Exception, match="labels -1 or"):
        sv.signed_kernel_product(zero_one.with_df(zero_one.df.withColumn("a", F.lit(0.5)))).collect()
    fit = sv.fit_svm_dual(pts, 6.0, n_iter=3)
    twice = pts.with_df(pts.df.unionByName(pts.df.limit(1)))
    with pytest.raises(Exception, match="one to one"):
        sv.dual_to_weights(fit.multipliers, twice, 6.0).collect()
    with lg.SparkEvaluator(fx.reg2_points(spark, SF_SMALL), "squared") as ev:
        assert tr.gradient_descent(ev, np.full(2, np.nan), None, 0.0).status == "not_finite"


def test_unusable_rows_are_dropped_counted_or_refused(spark):
    from ridgeway.sources.points import count_unusable, points_from_array, points_from_columns, points_from_vectors

    nan = float("nan")
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, nan, 2.0), (3, None, 2.0), (4, 1.0, None)], "id long, x double, y double")
    assert points_from_columns(df, [F.col("x")], F.col("y"), id="id").df.count() == 1
    assert tuple(count_unusable(df, [F.col("x")], F.col("y")).first()) == (4, 3)
    with pytest.raises(Exception, match="null or NaN"):
        points_from_columns(df, [F.col("x")], F.col("y"), bad="fail").df.collect()
    vec = spark.createDataFrame([([1.0, 2.0], 1.0), ([1.0, nan], 1.0), (None, 1.0), ([None, 1.0], 1.0)], "v array<double>, y double")
    assert points_from_vectors(vec, "v", "y", 2).df.count() == points_from_array(vec, "v", "y", 2).df.count() == 1
    with pytest.raises(Exception, match="not of length 2"):
        points_from_vectors(spark.createDataFrame([([1.0, 2.0, 3.0], 1.0)], "v array<double>, y double"), "v", "y", 2).df.collect()


@pytest.mark.parametrize("d", [201, 2100])
def test_wide_vector_points_fit(spark, d):
    from ridgeway.plans.api import fit
    from ridgeway.sources.points import points_from_vectors

    rng = np.random.default_rng(d)
    X = rng.normal(0, 1, (60, d)) / np.sqrt(d)
    y = X @ rng.normal(0, 1, d)
    df = spark.createDataFrame([(x.tolist(), float(v), float(np.sign(v))) for x, v in zip(X, y)], "f array<double>, y double, s double")
    squared = fit(points_from_vectors(df, "f", "y", d), "squared", pe.L2Penalty(), 0.1, lr=1.0, lr_decay=False, n_iter=4)
    logistic = fit(points_from_vectors(df, "f", "s", d), "logistic", pe.L2Penalty(), 0.1, lr=1.0, lr_decay=False, n_iter=4)
    for res in (squared, logistic):
        assert res.weights.shape == (d,) and res.path.shape[1] == d
        assert res.train_log[-1] < res.train_log[0]


def test_large_group_frames_are_not_broadcast(spark, monkeypatch):
    from ridgeway.sources import coefficients as co

    coef = co.embedding_coefficients(spark, SF_SMALL)
    groups = pe.groups_frame(spark, [list(range(8 * g + 1, 8 * g + 9)) for g in range(6)])
    want = {(r.model_id, r.feature_id): r.weight for r in pe.group_l1_prox(coef, groups, 0.2).collect()}
    monkeypatch.setattr(pe, "MAX_BROADCAST_GROUP_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pe.group_l1_prox(coef, groups, 0.2)
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        got = {(r.model_id, r.feature_id): r.weight for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
