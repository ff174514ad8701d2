"""C6 (re-aimed), C7, E6, E7, F8-F10: the dual SVM without a kernel matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ...operators import moments as mo
from ...operators import svm as sv
from ...sources import fixtures as fx
from ...sources.tables import table
from .. import oracle as o
from .registry import fitted, register, rounded

# --- SVM dual: C6 (re-aimed), C7, E6, E7, F8-F10 ------------------------------------------


SVM_LAMBDA = 3.0
SVM_A = 0.5  # evaluation point of C6/C7
SVM_D = fx.EMBEDDING
_FEATS = o.feats_of(SVM_D)


POWER_ROUNDS = 60


def _step(points) -> float:
    """2λ over the largest eigenvalue of XᵀX, by power iteration on the moments: steps that SQL can take too."""
    m = mo.collect_moments(points).xtx
    u, size = 1.0 + 0.01 * np.arange(1, SVM_D + 1), 1.0
    for _ in range(POWER_ROUNDS):
        y = m @ u
        size = float(np.sqrt(y @ y))
        u = y / size
    return 2.0 * SVM_LAMBDA / size


def _svm_fit(spark, sf_dir):
    pts = fx.svm_points(spark, sf_dir)
    return pts, fitted(spark, sf_dir, "svm", lambda: sv.fit_svm_dual(pts, SVM_LAMBDA, lr=_step(pts)))


def _svm_sql_parts():
    two_l = o.D(2.0 * SVM_LAMBDA)
    cols = range(1, SVM_D + 1)
    vm = o.margin_cols([f"v{j}" for j in cols], _FEATS)
    # the step: the same power iteration on the moment matrix as in ``_step``
    moments = ", ".join(f"sum(x{i} * x{j}) AS m{min(i, j)}_{max(i, j)}" for i in cols for j in cols if i <= j)
    mv = [" + ".join(f"m{min(i, j)}_{max(i, j)} * u{j}" for j in cols) for i in cols]
    norm = "sqrt(" + " + ".join(f"y{i} * y{i}" for i in cols) + ")"
    power = (
        f"mm AS MATERIALIZED (SELECT {moments} FROM p), pw(r, l, {', '.join(f'u{i}' for i in cols)}) AS (SELECT 0, {o.D(0)}, "
        f"{', '.join(o.D(1.0 + 0.01 * i) for i in cols)} UNION ALL SELECT r + 1, {norm}, "
        f"{', '.join(f'y{i} / {norm}' for i in cols)} FROM (SELECT r, {', '.join(f'{e} AS y{i}' for i, e in zip(cols, mv))} "
        f"FROM pw, mm WHERE r < {POWER_ROUNDS}) z), "
        f"eta AS MATERIALIZED (SELECT {two_l} / l AS eta FROM pw WHERE r = {POWER_ROUNDS})"
    )
    vsum = ", ".join(f"sum((a * label) * x{j}) AS v{j}" for j in cols)
    vs = ", ".join(f"v{j}" for j in cols)
    upd = f"greatest({o.D(0)}, least({o.D(1)}, (a - (eta * (((label * {vm}) / {two_l}) - 1.0)))))"
    # a state row holds all multipliers in the order of the ids
    rows = (f"SELECT k, unnest(al) AS a, unnest(range(1, len(al) + 1)) AS i FROM it "
            f"WHERE k < 20000 AND (dn IS NULL OR dn >= {o.D(1e-6)})")
    sums = f"SELECT k, list(a ORDER BY i) AS al, {vsum} FROM ({rows}) r JOIN pn USING (i) GROUP BY k"
    again = f"SELECT k, unnest(al) AS a, unnest(range(1, len(al) + 1)) AS i, {vs} FROM ({sums}) z"
    step = f"SELECT k, i, a, {upd} AS na FROM ({again}) y JOIN pn USING (i), eta"
    cte = (
        f"WITH RECURSIVE p AS MATERIALIZED ({fx.duck_sql('SVM')}), pn AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY id) AS i FROM p), {power}, "
        f"it(k, al, dn) AS (SELECT 0, (SELECT list({o.D(0)}) FROM p), CAST(NULL AS DOUBLE) UNION ALL "
        f"SELECT k + 1, list(na ORDER BY i), sqrt(sum((na - a) * (na - a) ORDER BY i)) FROM ({step}) q GROUP BY k), "
        f"st AS MATERIALIZED (SELECT k, dn, unnest(al) AS a, unnest(range(1, len(al) + 1)) AS i FROM it), "
        f"hist AS (SELECT k, {vsum}, sum(a) AS sa, max(dn) AS dn FROM st JOIN pn USING (i) GROUP BY k), "
        f"wh AS (SELECT k, dn, {', '.join(f'v{j} / {two_l} AS w{j}' for j in cols)}, "
        f"((-({' + '.join(f'(v{j} * v{j})' for j in cols)})) / {o.D(4.0 * SVM_LAMBDA)}) + sa AS dual "
        f"FROM hist), fin AS (SELECT * FROM wh ORDER BY k DESC LIMIT 1), "
        f"pr AS (SELECT k, any_value(dual) AS dual, sum(greatest({o.D(0)}, {o.D(1)} - (label * "
        f"{o.margin_cols([f'w{j}' for j in cols], _FEATS)}))) + ({o.D(SVM_LAMBDA)} * any_value("
        f"{' + '.join(f'(w{j} * w{j})' for j in cols)})) AS primal FROM wh, p GROUP BY k)"
    )
    return cte


_SVM_CTE = _svm_sql_parts()


@register("fit_svm_dual", f"{_SVM_CTE} SELECT pn.id, {o.R('a')} AS a FROM st JOIN pn USING (i) WHERE k = (SELECT max(k) FROM it)")
def fit_svm_dual(spark, sf_dir):
    """Dual SVM on SVM (λ=3, step from the largest moment eigenvalue) by projected gradient to ‖Δa‖ < 1e-6; multipliers per row."""
    _, fit = _svm_fit(spark, sf_dir)
    return rounded(fit.multipliers)


@register(
    "dual_to_weights",
    f"{_SVM_CTE} SELECT 0 AS model_id, 0 AS class_id, CAST(e.j AS INTEGER) AS feature_id, e.w AS weight FROM (SELECT unnest(["
    + ", ".join(f"{{'j': {j}, 'w': {o.R(f'w{j}')}}}" for j in range(1, SVM_D + 1)) + "]) AS e FROM fin) u",
)
def dual_to_weights(spark, sf_dir):
    """Primal weights (1/2λ)·Σ a y x from the fitted multipliers joined to the points by id."""
    pts, fit = _svm_fit(spark, sf_dir)
    return rounded(sv.dual_to_weights(fit.multipliers, pts, SVM_LAMBDA))


@register("primal_history", f"{_SVM_CTE} SELECT CAST(k AS INTEGER) AS iter, {o.R('primal')} AS primal FROM pr")
def primal_history(spark, sf_dir):
    """F8: Σ hinge + λ‖w‖² at every iterate of the dual fit (up to 500 iterates scored per job)."""
    pts, fit = _svm_fit(spark, sf_dir)
    hist = sv.primal_history(pts, fit)
    return rounded(spark.createDataFrame(list(enumerate(hist)), "iter int, primal double"))


@register(
    "duality_gap",
    f"{_SVM_CTE} SELECT CAST(k AS INTEGER) AS iter, {o.R('primal')} AS primal, {o.R('dual')} AS dual, "
    f"{o.R('primal - dual')} AS gap FROM pr",
)
def duality_gap(spark, sf_dir):
    """primal and dual objective per iterate and their gap."""
    pts, fit = _svm_fit(spark, sf_dir)
    hist = sv.primal_history(pts, fit)
    rows = [(t, p_, d_, p_ - d_) for t, (p_, d_) in enumerate(zip(hist, fit.dual_hist))]
    return rounded(spark.createDataFrame(rows, "iter int, primal double, dual double, gap double"))


@register(
    "classify_svm",
    f"{_SVM_CTE} SELECT p.id, {o.R('m')} AS margin, CASE WHEN m >= 0 THEN {o.D(1)} ELSE {o.D(-1)} END AS prediction "
    f"FROM (SELECT p.id, {o.margin_cols([f'w{j + 1}' for j in range(SVM_D)], _FEATS)} AS m FROM p, fin) p",
)
def classify_svm(spark, sf_dir):
    """margin and ±1 class of every SVM row under the fitted weights."""
    pts, fit = _svm_fit(spark, sf_dir)
    return rounded(sv.classify(pts, fit.weights))


def _svm_at_half(spark, sf_dir):
    pts = fx.svm_points(spark, sf_dir)
    return pts.with_df(pts.df.withColumn("a", F.lit(SVM_A)))


_HALF_V = (
    f"WITH p AS ({fx.duck_sql('SVM')}), q AS (SELECT *, {o.D(SVM_A)} AS a FROM p), "
    f"v AS (SELECT {', '.join(f'sum((a * label) * x{j + 1}) AS v{j + 1}' for j in range(SVM_D))}, sum(a) AS sa FROM q) "
)
_HALF_M = o.margin_cols([f"v{j + 1}" for j in range(SVM_D)], _FEATS)


@register(
    "dual_objective_grad",
    _HALF_V + f"SELECT q.id, {o.R('q.a')} AS a, {o.R(f'((label * {_HALF_M}) / {o.D(2 * SVM_LAMBDA)}) - 1.0')} AS grad, "
    + o.R(f"((-({' + '.join(f'(v{j} * v{j})' for j in range(1, SVM_D + 1))})) / {o.D(4 * SVM_LAMBDA)}) + sa") + " AS objective FROM q, v",
)
def dual_objective_grad(spark, sf_dir):
    """Dual objective D(a) and ∇(−D) per row at a = 0.5, without the kernel matrix."""
    return rounded(sv.dual_objective_grad(_svm_at_half(spark, sf_dir), SVM_LAMBDA).withColumnRenamed("vec_id", "id"))


@register("signed_kernel_product", _HALF_V + f"SELECT q.id, {o.R(f'label * {_HALF_M}')} AS ka FROM q, v")
def signed_kernel_product(spark, sf_dir):
    """C6 (re-aimed): (K a)_i = y_i x_i·Σ a y x for every row at a = 0.5, O(n d), no pair table."""
    pts = _svm_at_half(spark, sf_dir)
    return rounded(sv.signed_kernel_product(pts).select(F.col("id"), "ka"))


@register(
    "trace_table_svm",
    f"{_SVM_CTE} SELECT 'svm' AS run_id, CAST(wh.k AS INTEGER) AS iter, {o.R('wh.dual')} AS loss, "
    f"CASE WHEN nx.k IS NOT NULL THEN {o.R('(SELECT eta FROM eta)')} END AS eta, {o.R('nx.dn')} AS norm "
    f"FROM wh LEFT JOIN wh nx ON nx.k = wh.k + 1",
)
def trace_table_svm(spark, sf_dir):
    """A6 for the dual SVM: D(a_t), η_t and ‖a_{t+1} − a_t‖ per iterate (the norm is the next step's aggregate)."""
    _, fit = _svm_fit(spark, sf_dir)
    return rounded(fit.trace_frame(spark, "svm").select("run_id", "iter", "loss", "eta", "norm"))


@register(
    "fit_svm_ascent",
    f"{_SVM_CTE} SELECT CAST(e.j AS INTEGER) AS feature_id, e.w AS weight, e.dual AS objective, true AS closed FROM (SELECT unnest(["
    + ", ".join(f"{{'j': {j}, 'w': {o.R(f'w{j}', 3)}, 'dual': {o.R('dual', 3)}}}" for j in range(1, SVM_D + 1)) + "]) AS e FROM fin) u",
)
def fit_svm_ascent(spark, sf_dir):
    """E6 by coordinate ascent inside partitions: the model on SVM, its dual objective, and whether the duality gap closed to 1e-6."""
    fit = sv.fit_svm_ascent(fx.svm_points(spark, sf_dir), SVM_LAMBDA, gap_tol=1e-8)
    closed = fit.norm_hist[-1] <= 1e-6 * max(1.0, abs(fit.dual_hist[-1]))
    rows = [(j + 1, float(w), float(fit.dual_hist[-1]), closed) for j, w in enumerate(fit.weights)]
    return rounded(spark.createDataFrame(rows, "feature_id int, weight double, objective double, closed boolean"), 3)
