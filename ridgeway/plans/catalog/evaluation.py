"""F1-F7, E8, E12, E14, G1 (margin loss), A7, B11: scoring, traces and many-model scans."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ...functions.losses import CustomLoss, quadratic_bowl
from ...operators import evaluate as ev_ops
from ...operators import loss_grad as lg
from ...operators import moments as mo
from ...operators.expansion import ExpandedEvaluator
from ...operators.line_search import line_search_table
from ...operators.penalties import BoxProjector, GroupL1Penalty, L2Penalty
from ...session import scratch_path
from ...sources import fixtures as fx
from ...sources import sinks
from ...sources.points import PointSet
from ...sources.points import held_out_split as _split
from .. import oracle as o
from .. import params as P
from .. import trainers as tr
from .fits import GROUP_LR, GRP_GROUPS, LAMBDA_GROUP, LAMBDA_MULTI, _LASSO_PATH, _MULTI_FIT, _PROX_BIN, _fit_bin_prox, _lasso_path, _model
from .registry import register, rounded

# --- F1-F7, F11, E8, E12, E14, G1, A7, B11 ------------------------------------------------


_GRID = P.grid()
_GRID_VALUES = ", ".join(f"({i}, {j}, {o.D(a)}, {o.D(b)})" for i, j, a, b in _GRID)


def _grid_frame(spark):
    return spark.createDataFrame([(k, i, j, a, b) for k, (i, j, a, b) in enumerate(_GRID)],
                                 "model int, cell_i int, cell_j int, w1 double, w2 double")


@register(
    "loss_surface_grid",
    f"WITH p AS ({fx.duck_sql('BIN2')}), g(cell_i, cell_j, w1, w2) AS (VALUES {_GRID_VALUES}) "
    f"SELECT cell_i, cell_j, {o.R('w1')} AS w1, {o.R('w2')} AS w2, "
    f"{o.R('sum(' + o.pointwise('logistic', ['((w1 * x1) + (w2 * x2))'], 'label')[0] + ') / count(*)')} AS loss "
    f"FROM g, p GROUP BY cell_i, cell_j, w1, w2",
)
def loss_surface_grid(spark, sf_dir):
    """mean logistic loss of BIN2 at each of 22×22 weight pairs, all 484 models in one scan."""
    pts = fx.bin2_points(spark, sf_dir)
    Ws = np.array([[a, b] for _, _, a, b in _GRID])
    losses = lg.models_frame(pts, "logistic", Ws)
    grid = F.broadcast(_grid_frame(spark))  # 484 parameter rows
    out = grid.join(losses, "model").select("cell_i", "cell_j", "w1", "w2", (F.col("loss_sum") / F.col("n")).alias("loss"))
    return rounded(out)


def _bowl_sql():
    m = (f"WITH p AS ({fx.duck_sql('REG2')}), m AS (SELECT count(*) AS n, sum(x1 * x1) AS a11, sum(x1 * x2) AS a12, "
         f"sum(x2 * x2) AS a22, sum(x1 * label) AS b1, sum(x2 * label) AS b2 FROM p), "
         f"q AS (SELECT a11 / (2 * n) AS A11, a12 / (2 * n) AS A12, a22 / (2 * n) AS A22, "
         f"(b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS mu1, (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS mu2 "
         f"FROM m), g(cell_i, cell_j, w1, w2) AS (VALUES {_GRID_VALUES}) ")
    d1, d2 = "(w1 - mu1)", "(w2 - mu2)"
    bowl = f"(((({d1} * A11) * {d1}) + (({d1} * A12) * {d2})) + (({d2} * A12) * {d1})) + (({d2} * A22) * {d2})"
    return m + f"SELECT cell_i, cell_j, {o.R('w1')} AS w1, {o.R('w2')} AS w2, {o.R(bowl)} AS bowl FROM g, q"


@register("quadratic_bowl", _bowl_sql())
def quadratic_bowl_query(spark, sf_dir):
    """(w−μ)ᵀA(w−μ) on the 22×22 grid, A = XᵀX/(2n), μ = least squares of REG2 (one moments scan)."""
    m = mo.collect_moments(fx.reg2_points(spark, sf_dir))
    A = m.xtx / (2.0 * m.n)
    mu = np.linalg.solve(m.xtx, m.xty)
    g = _grid_frame(spark)
    expr = quadratic_bowl([F.col("w1"), F.col("w2")], A.tolist(), mu.tolist())
    return rounded(g.select("cell_i", "cell_j", "w1", "w2", expr.alias("bowl")))


def _line_search_sql(eta0=20.0, rho=P.ARMIJO_RHO, c1=P.ARMIJO_C1, M=16):
    W = list(P.W_BIN)
    lam = P.LAMBDA_L2
    feats = o.feats_of(4)
    z = o.margin(W, feats)
    l, dl = o.pointwise("logistic", ["z"], "label")
    grads = ", ".join(f"sum({dl[0]} * x{j + 1}) AS s{j + 1}" for j in range(4))
    pen_w = " + ".join(f"({o.D(w)} * {o.D(w)})" for w in W)
    g = (f"g AS (SELECT count(*) AS n, sum({l}) AS ls, {grads} FROM (SELECT *, {z} AS z FROM p)), "
         f"h AS (SELECT n, (ls / n) + ({o.D(lam)} * (({pen_w}) / 2.0)) AS F0, "
         + ", ".join(f"(s{j + 1} / n) + ({o.D(lam)} * {o.D(W[j])}) AS g{j + 1}" for j in range(4)) + " FROM g), "
         f"hd AS (SELECT *, {', '.join(f'-g{j + 1} AS d{j + 1}' for j in range(4))} FROM h), "
         f"hs AS (SELECT *, {' + '.join(f'(g{j + 1} * d{j + 1})' for j in range(4))} AS slope FROM hd), ")
    cands = (f"c AS (SELECT m, eta, F0, slope, {', '.join(f'{o.D(W[j])} + (eta * d{j + 1}) AS c{j + 1}' for j in range(4))} "
             f"FROM (SELECT CAST(m AS INTEGER) AS m, {o.D(eta0)} * pow({o.D(rho)}, m) AS eta FROM range(0, {M}) t(m)), hs), ")
    cz = o.margin_cols([f"c{j + 1}" for j in range(4)], feats)
    cl, _ = o.pointwise("logistic", [cz], "label")
    pen_c = " + ".join(f"(c{j + 1} * c{j + 1})" for j in range(4))
    ev = (f"e AS (SELECT m, eta, (sum({cl}) / count(*)) + ({o.D(lam)} * (({pen_c}) / 2.0)) AS objective, "
          f"F0 + (({o.D(c1)} * eta) * slope) AS bound FROM c, p GROUP BY m, eta, F0, slope, c1, c2, c3, c4), "
          f"a AS (SELECT *, objective <= bound AS armijo FROM e)")
    return (f"WITH p AS ({fx.duck_sql('BIN')}), {g}{cands}{ev} SELECT m, {o.R('eta')} AS eta, {o.R('objective')} AS objective, "
            f"{o.R('bound')} AS bound, armijo, COALESCE(m = (SELECT min(m) FROM a WHERE armijo), false) AS chosen FROM a")


@register("batched_line_search", _line_search_sql())
def batched_line_search(spark, sf_dir):
    """16 Armijo candidates η=20·0.9^m for logistic + L2 on BIN at W_BIN, scored in one aggregate."""
    pts = fx.bin_points(spark, sf_dir)
    t = line_search_table(pts, "logistic", list(P.W_BIN), L2Penalty(), P.LAMBDA_L2, eta0=20.0, rho=P.ARMIJO_RHO,
                          c1=P.ARMIJO_C1, candidates=16)
    return rounded(t)


def _optimum_sql(fit: o.FitSQL, keys: str) -> str:
    """The converged model of a first-order chain at three digits, as every solver must report it."""
    return f"WITH opt AS ({fit.model_sql(3)}) SELECT {keys}, weight, status FROM opt"


def _four_solvers(ev, w0, lam, lr) -> dict[str, tr.FitResult]:
    pen = L2Penalty()
    return {
        "gradient_descent": tr.gradient_descent(ev, w0, pen, lam, lr=lr),
        "bfgs": tr.bfgs(ev, w0, pen, lam, lr=lr),
        "proximal": tr.proximal_gradient(ev, w0, pen, lam, lr=lr, lr_decay=False),
        "accelerated_proximal": tr.accelerated_proximal(ev, w0, pen, lam, lr=lr, lr_decay=False),
    }


SOLVERS4 = ("gradient_descent", "bfgs", "proximal", "accelerated_proximal")


def _each_solver(sql: str, keys: str) -> str:
    values = ", ".join(f"('{name}')" for name in SOLVERS4)
    return f"SELECT s.solver, {keys}, r.weight, r.status FROM ({sql}) r, (VALUES {values}) s(solver)"


@register("fit_binary_logistic_l2", _optimum_sql(_PROX_BIN, "model_id, class_id, feature_id"))
def fit_binary_logistic_l2(spark, sf_dir):
    """L2 logistic regression on BIN (λ=0.01, init 0) by BFGS to ‖∇‖ < 1e-6; 3 digits."""
    with lg.SparkEvaluator(fx.bin_points(spark, sf_dir), "logistic") as ev:
        res = tr.bfgs(ev, np.zeros(4), L2Penalty(), P.LAMBDA_L2, lr=1.0, c1=P.ARMIJO_C1, rho=P.ARMIJO_RHO)
    return _model(spark, res, 3, iterations=False)


@register("solver_comparison", _each_solver(_optimum_sql(_PROX_BIN, "feature_id"), "r.feature_id"))
def solver_comparison(spark, sf_dir):
    """the four solvers of the binary example on BIN (λ=0.01), each to its tolerance, side by side at 3 digits."""
    with lg.SparkEvaluator(fx.bin_points(spark, sf_dir), "logistic") as ev:
        fits = _four_solvers(ev, np.zeros(4), P.LAMBDA_L2, P.LR_BIN)
    rows = [(name, j + 1, float(w), res.status) for name, res in fits.items() for j, w in enumerate(res.weights)]
    return rounded(spark.createDataFrame(rows, "solver string, feature_id int, weight double, status string"), 3)


@register("solver_comparison_multiclass", _each_solver(_optimum_sql(_MULTI_FIT, "class_id, feature_id"), "r.class_id, r.feature_id"))
def solver_comparison_multiclass(spark, sf_dir):
    """F11 for the multiclass case: four solvers on MULTI softmax + L2 (λ=0.05, init ones(3,4)), each to its tolerance."""
    with ExpandedEvaluator(lg.SparkEvaluator(fx.multi_points(spark, sf_dir), "softmax")) as ev:
        fits = _four_solvers(ev, np.ones((3, 4)), LAMBDA_MULTI, P.LR_MULTI)
    rows = [(name, c, j + 1, float(res.weights[c, j]), res.status) for name, res in fits.items() for c in range(3) for j in range(4)]
    schema = "solver string, class_id int, feature_id int, weight double, status string"
    return rounded(spark.createDataFrame(rows, schema), 3)


_TRACE_FIT = o.trace_cte(_PROX_BIN)


@register(
    "convergence_gap",
    f"{_TRACE_FIT} SELECT 'prox_bin' AS run_id, iter, {o.R('abs(loss - (SELECT loss FROM tr WHERE iter = (SELECT max(iter) FROM tr)))')} "
    f"AS gap FROM tr",
)
def convergence_gap(spark, sf_dir):
    """|J(w_t) − J(ŵ)| along the proximal BIN fit."""
    t = _fit_bin_prox(spark, sf_dir).trace_frame(spark, "prox_bin")
    return rounded(ev_ops.convergence_gap(t))


def _wdist(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"(({a}.w_0_{j} - {b}.w_0_{j}) * ({a}.w_0_{j} - {b}.w_0_{j}))" for j in range(1, 5)) + ")"


@register(
    "path_distance",
    f"{_TRACE_FIT} SELECT 'prox_bin' AS run_id, t.iter, {o.R(_wdist('t', 'f'))} AS distance FROM tr t, "
    f"(SELECT * FROM tr WHERE iter = (SELECT max(iter) FROM tr)) f",
)
def path_distance(spark, sf_dir):
    """‖w_t − ŵ‖ along the proximal BIN fit."""
    t = _fit_bin_prox(spark, sf_dir).trace_frame(spark, "prox_bin")
    return rounded(ev_ops.path_distance(t))


@register(
    "step_norm",
    f"{_TRACE_FIT} SELECT 'prox_bin' AS run_id, t.iter, {o.R(_wdist('t', 'q'))} AS step_norm FROM tr t "
    f"LEFT JOIN tr q ON q.iter = t.iter - 1",
)
def step_norm(spark, sf_dir):
    """‖w_t − w_{t−1}‖ along the proximal BIN fit (lag over the trace)."""
    t = _fit_bin_prox(spark, sf_dir).trace_frame(spark, "prox_bin")
    return rounded(ev_ops.step_norm(t))


_DECAY = o.FitSQL("REG2", "squared", 1, 2, P.N_ITER, [[0.5, 0.5]], "project_box", lr=1.0, decay=True, data="moments")


@register(
    "step_schedule",
    f"{_DECAY.cte()} SELECT CAST(k - 1 AS INTEGER) AS iter, {o.R(f'{o.D(1.0)} / sqrt(k)')} AS eta, {o.R('dnorm')} AS norm "
    f"FROM it WHERE k >= 1",
)
def step_schedule(spark, sf_dir):
    """η_t = lr/√t and the step it takes, ‖Δw‖, in the projected-gradient fit of REG2, step by step until < 1e-6."""
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, sf_dir))
    res = tr.projected_gradient(ev, np.full(2, 0.5), BoxProjector(0.0, 1.0), lr=1.0, lr_decay=True)
    t = res.trace_frame(spark, "decay")
    return rounded(t.where(F.col("eta").isNotNull()).select("iter", "eta", "norm"))


@register("model_table", _PROX_BIN.model_sql(status=False))
def model_table(spark, sf_dir):
    """The proximal BIN model written as Parquet to the shared folder and read back."""
    res = _fit_bin_prox(spark, sf_dir)
    path = sinks.write_model(res.model_frame(spark), scratch_path(spark, "model"))
    return rounded(sinks.read_model(spark, path))


QUADRATIC = CustomLoss(
    "quadratic",
    lambda z, y: ((z - y) * (z - y), F.lit(2.0) * (z - y)),
    lambda z, y: ((z - y) * (z - y), 2.0 * (z - y)),
)


@register("custom_loss_quadratic", o.loss_grad_long("REG", "quadratic", [list(P.W_REG)]))
def custom_loss_quadratic(spark, sf_dir):
    """G1: a user-supplied loss (z − y)² plugged into the mean loss/gradient aggregate over REG."""
    return rounded(lg.loss_grad_long(fx.reg_points(spark, sf_dir), QUADRATIC, [list(P.W_REG)]))


_GTRAIN = o.FitSQL("GRP_TRAIN", "squared", 1, 65, P.N_ITER, [[0.0] * 65], "prox_group", lam=LAMBDA_GROUP, lr=GROUP_LR,
                   groups=GRP_GROUPS, data="moments", accelerated=True)
_PRED_SQL = (
    f"{_GTRAIN.cte()}, allp AS ({fx.duck_sql('GRP')}), pr AS (SELECT allp.id, CASE WHEN allp.id % 5 = 0 THEN 'test' "
    f"ELSE 'train' END AS split, allp.label, {o.margin_cols([f'w_0_{j + 1}' for j in range(65)], o.feats_of(65))} "
    f"AS prediction FROM allp, (SELECT * FROM it ORDER BY k DESC LIMIT 1) it) "
)


def _predictions(spark, sf_dir):
    pts = fx.grp_points(spark, sf_dir)
    tagged = _split(pts)
    train = PointSet(tagged.where(F.col("split") == "train"), pts.features, pts.label, pts.id)
    ev = mo.MomentsEvaluator.from_points(train)
    res = tr.accelerated_proximal(ev, np.zeros(65), GroupL1Penalty([[j - 1 for j in g] for g in GRP_GROUPS]),
                                  LAMBDA_GROUP, lr=GROUP_LR, lr_decay=False)
    return ev_ops.predict_linear(pts.with_df(tagged), res.weights, keep=["split"])


@register("predict_linear", _PRED_SQL + f"SELECT id, split, {o.R('label')} AS label, {o.R('prediction')} AS prediction FROM pr")
def predict_linear(spark, sf_dir):
    """ŷ = x̃·w for every GRP row, w the group lasso fitted on the train split."""
    return rounded(_predictions(spark, sf_dir).withColumnRenamed("vec_id", "id"))


@register(
    "mean_squared_error",
    _PRED_SQL + f"SELECT split, {o.R('sum((prediction - label) * (prediction - label)) / count(*)')} AS mse, "
    f"count(*) AS n FROM pr GROUP BY split",
)
def mean_squared_error(spark, sf_dir):
    """train and test mean squared error of the group lasso predictions."""
    return rounded(ev_ops.mean_squared_error(_predictions(spark, sf_dir), by=["split"]))


@register(
    "coefficient_residual",
    _LASSO_PATH.cte() + f", rm AS (SELECT count(*) AS n, sum(x1 * x1) AS a11, sum(x1 * x2) AS a12, sum(x2 * x2) AS a22, "
    f"sum(x1 * label) AS b1, sum(x2 * label) AS b2 FROM p), rs AS (SELECT a11 + {o.D(1.0)} AS A, a12 AS B, "
    f"a22 + {o.D(1.0)} AS Cc, b1 AS u, b2 AS v FROM rm), rw AS (SELECT (u * Cc - B * v) / (A * Cc - B * B) AS r1, "
    f"(A * v - B * u) / (A * Cc - B * B) AS r2 FROM rs) "
    f"SELECT 0 AS model_id, {o.R('((w_0_1 - r1) * (w_0_1 - r1) + (w_0_2 - r2) * (w_0_2 - r2)) / 2')} AS residual "
    f"FROM it, rw WHERE lam = {o.D(P.LAMBDAS_REG2[0])} AND {_LASSO_PATH.last()}",
)
def coefficient_residual(spark, sf_dir):
    """mean (w − w')² between the λ=0.01 lasso and the closed-form ridge (λ=1) on REG2."""
    lam, res = _lasso_path(spark, sf_dir)[0]
    m = mo.collect_moments(fx.reg2_points(spark, sf_dir))
    ridge = spark.createDataFrame(tr.model_rows(mo.ridge_closed_form(m, 1.0)), tr.MODEL_SCHEMA)
    return rounded(ev_ops.coefficient_residual(res.model_frame(spark), ridge))
