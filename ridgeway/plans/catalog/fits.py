"""Trainers run to tolerance as Spark jobs, with recursive-CTE or closed-form oracles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import loss_grad as lg
from ...operators import moments as mo
from ...operators.penalties import BoxProjector, GroupL1Penalty, L1Penalty, L2Penalty
from ...sources import fixtures as fx
from .. import oracle as o
from .. import params as P
from .. import trainers as tr
from .registry import fitted, register, rounded

# --- E1-E5, E9-E14: trainers ----------------------------------------------------------


GRP_GROUPS = [list(range(8 * g + 1, 8 * g + 9)) for g in range(8)]  # eight groups of eight, the bias stays free
LAMBDA_GROUP = 0.04
LAMBDA_GROUP_SQRT = 0.03
BOX = (-0.35, 1.0)  # cuts into the unconstrained optimum on BIN
LAMBDA_RIDGE2 = 0.05


def _model(spark, res: tr.FitResult, digits: int = 6, iterations: bool = True) -> DataFrame:
    """The fitted model with how the fit ended (and after how many steps, where the oracle takes the same ones)."""
    out = rounded(res.model_frame(spark), digits)
    if iterations:
        out = out.withColumn("iterations", F.lit(res.iterations).cast("int"))
    return out.withColumn("status", F.lit(res.status))


def _fit_bin_prox(spark, sf_dir):
    def run():
        with lg.SparkEvaluator(fx.bin_points(spark, sf_dir), "logistic") as ev:
            return tr.proximal_gradient(ev, np.zeros(4), L2Penalty(), P.LAMBDA_L2, lr=P.LR_BIN, lr_decay=False)

    return fitted(spark, sf_dir, "bin_prox", run)


def _fit_bin_accelerated(spark, sf_dir):
    def run():
        with lg.SparkEvaluator(fx.bin_points(spark, sf_dir), "logistic") as ev:
            return tr.accelerated_proximal(ev, np.zeros(4), L1Penalty(), LAMBDA_L1, lr=P.LR_BIN, lr_decay=False)

    return fitted(spark, sf_dir, "bin_accelerated", run)


_PROX_BIN = o.FitSQL("BIN", "logistic", 1, 4, P.N_ITER, [[0.0] * 4], "prox_l2", lam=P.LAMBDA_L2, lr=P.LR_BIN)


@register("fit_proximal_gradient", _PROX_BIN.model_sql())
def fit_proximal_gradient(spark, sf_dir):
    """Logistic + L2 on BIN by proximal gradient to ‖Δw‖ < 1e-6, one aggregate a step."""
    return _model(spark, _fit_bin_prox(spark, sf_dir))


@register("trace_table", _PROX_BIN.trace_sql("prox_bin"))
def trace_table(spark, sf_dir):
    """Per-iterate trace (objective, step, ‖Δw‖) of the proximal fit."""
    res = _fit_bin_prox(spark, sf_dir)
    t = res.trace_frame(spark, "prox_bin").select("run_id", "iter", "loss", "eta", "norm")
    return rounded(t)


LAMBDA_L1 = 0.05  # zeroes a coefficient on BIN
_ACC_BIN = o.FitSQL("BIN", "logistic", 1, 4, P.N_ITER, [[0.0] * 4], "prox_l1", lam=LAMBDA_L1, lr=P.LR_BIN,
                    accelerated=True)


@register("fit_accelerated_proximal", _ACC_BIN.model_sql())
def fit_accelerated_proximal(spark, sf_dir):
    """Logistic + L1 on BIN by accelerated proximal gradient to ‖Δw‖ < 1e-6."""
    res = _fit_bin_accelerated(spark, sf_dir)
    return _model(spark, res)


@register("trace_table_accelerated", _ACC_BIN.trace_sql("acc_bin", with_eval_point=True))
def trace_table_accelerated(spark, sf_dir):
    """A6 + Q6: trace of the accelerated L1 fit; objectives at the extrapolated points, the last at w."""
    res = _fit_bin_accelerated(spark, sf_dir)
    return rounded(res.trace_frame(spark, "acc_bin").select("run_id", "iter", "loss", "eta", "norm", "eval_point"))


_PROJ_BIN = o.FitSQL("BIN", "logistic", 1, 4, P.N_ITER, [[0.5] * 4], "project_box", lr=P.LR_BIN, box=BOX)


@register("fit_projected_gradient", _PROJ_BIN.model_sql())
def fit_projected_gradient(spark, sf_dir):
    """E5: logistic loss on BIN with weights kept in a box that some of them reach, to ‖Δw‖ < 1e-6."""
    ev = lg.SparkEvaluator(fx.bin_points(spark, sf_dir), "logistic")
    try:
        res = tr.projected_gradient(ev, np.full(4, 0.5), BoxProjector(*BOX), lr=P.LR_BIN, lr_decay=False)
    finally:
        ev.close()
    return _model(spark, res)


LAMBDA_MULTI = 0.05
_MULTI_FIT = o.FitSQL("MULTI", "softmax", 3, 4, P.N_ITER, [[1.0] * 4] * 3, "prox_l2", lam=LAMBDA_MULTI, lr=P.LR_MULTI,
                      accelerated=True)


@register("fit_multiclass_logistic_l2", _MULTI_FIT.model_sql())
def fit_multiclass_logistic_l2(spark, sf_dir):
    """Softmax + L2 on MULTI from ones(3, 4), accelerated proximal gradient to ‖Δw‖ < 1e-6."""
    ev = lg.SparkEvaluator(fx.multi_points(spark, sf_dir), "softmax")
    try:
        res = tr.accelerated_proximal(ev, np.ones((3, 4)), L2Penalty(), LAMBDA_MULTI, lr=P.LR_MULTI, lr_decay=False)
    finally:
        ev.close()
    return _model(spark, res)


GROUP_LR = 0.9  # below 1/L of the squared loss on GRP


def _group_fit(threshold, lam):
    sql = o.FitSQL("GRP", "squared", 1, 65, P.N_ITER, [[0.0] * 65], "prox_group", lam=lam, lr=GROUP_LR,
                   groups=GRP_GROUPS, threshold=threshold, data="moments", accelerated=True)

    def run(spark, sf_dir):
        ev = mo.MomentsEvaluator.from_points(fx.grp_points(spark, sf_dir))
        pen = GroupL1Penalty([[j - 1 for j in g] for g in GRP_GROUPS], threshold)
        return _model(spark, tr.accelerated_proximal(ev, np.zeros(65), pen, lam, lr=GROUP_LR, lr_decay=False))

    run.__doc__ = f"E11: group lasso on GRP (8 groups + free bias), accelerated, to ‖Δw‖ < 1e-6, threshold={threshold}"
    return sql.model_sql(), run


for _name, _thr, _lam in (("fit_group_lasso", "exact", LAMBDA_GROUP), ("fit_group_lasso_sqrt_threshold", "sqrt_size", LAMBDA_GROUP_SQRT)):
    _sql, _fn = _group_fit(_thr, _lam)
    register(_name, _sql)(_fn)


_LASSO_PATH = o.FitSQL("REG2", "squared", 1, 2, P.N_ITER, [[0.0, 0.0]], "prox_l1", lr=1.0, data="moments",
                       lambdas=list(P.LAMBDAS_REG2), tol=1e-6)


def _lasso_path(spark, sf_dir):
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, sf_dir))
    return [(lam, tr.proximal_gradient(ev, np.zeros(2), L1Penalty(), lam, lr=1.0, lr_decay=False))
            for lam in P.LAMBDAS_REG2]


@register(
    "lambda_path",
    _LASSO_PATH.cte() + " " + " UNION ALL ".join(
        f"SELECT {o.R('lam')} AS lambda, {j + 1} AS feature_id, {o.R(f'w_0_{j + 1}')} AS weight "
        f"FROM it WHERE {_LASSO_PATH.last()}" for j in range(2)
    ),
)
def lambda_path(spark, sf_dir):
    """Lasso on REG2 for each λ (one moments scan, then proximal steps to ‖Δw‖ < 1e-6)."""
    rows = [(float(lam), j + 1, float(res.weights[j])) for lam, res in _lasso_path(spark, sf_dir) for j in range(2)]
    return rounded(spark.createDataFrame(rows, "lambda double, feature_id int, weight double"))


def _ridge2_sql(lam_expr: str, scale: str, digits: int) -> str:
    """Cramer's rule for (A + λI) w = b with A, b the REG2 moments (optionally /n)."""
    div = " / n" if scale == "mean" else ""
    return (
        f"WITH p AS ({fx.duck_sql('REG2')}), m AS (SELECT count(*) AS n, sum(x1 * x1) AS a11, sum(x1 * x2) AS a12, "
        f"sum(x2 * x2) AS a22, sum(x1 * label) AS b1, sum(x2 * label) AS b2 FROM p), "
        f"s AS (SELECT a11{div} + {lam_expr} AS A, a12{div} AS B, a22{div} + {lam_expr} AS Cc, b1{div} AS u, "
        f"b2{div} AS v FROM m) "
        f"SELECT 0 AS model_id, 0 AS class_id, 1 AS feature_id, {o.R('(u * Cc - B * v) / (A * Cc - B * B)', digits)} "
        f"AS weight FROM s UNION ALL SELECT 0, 0, 2, {o.R('(A * v - B * u) / (A * Cc - B * B)', digits)} FROM s"
    )


def _converged(sql: str) -> str:
    """The closed form's rows as a fit that has reached them reports."""
    head, body = sql.split(" SELECT 0 AS model_id", 1)
    return f"{head} SELECT *, 'converged' AS status FROM (SELECT 0 AS model_id{body}) z"


def _search_fit(spark, sf_dir, trainer) -> DataFrame:
    """Ridge on REG2 from an lr that the Armijo search must shrink; each step is a scan of the rows."""
    with lg.SparkEvaluator(fx.reg2_points(spark, sf_dir), "squared", strategy="column") as ev:
        res = trainer(ev, np.zeros(2), L2Penalty(), LAMBDA_RIDGE2, lr=8.0, c1=P.ARMIJO_C1, rho=P.ARMIJO_RHO)
    return _model(spark, res, 3, iterations=False)


@register("fit_gd_armijo", _converged(_ridge2_sql(o.D(LAMBDA_RIDGE2), "mean", 3)))
def fit_gd_armijo(spark, sf_dir):
    """Ridge on REG2 by steepest descent with Armijo backtracking, run to ‖∇‖ < 1e-6."""
    return _search_fit(spark, sf_dir, tr.gradient_descent)


@register("fit_bfgs", _converged(_ridge2_sql(o.D(LAMBDA_RIDGE2), "mean", 3)))
def fit_bfgs(spark, sf_dir):
    """Ridge on REG2 by BFGS with the same Armijo search, run to ‖∇‖ < 1e-6."""
    return _search_fit(spark, sf_dir, tr.bfgs)


@register("fit_ridge_closed_form", _ridge2_sql(o.D(1.0), "sum", 6))
def fit_ridge_closed_form(spark, sf_dir):
    """pinv(XᵀX + λI)·Xᵀy on REG2 with λ = 1 (unnormalised sums)."""
    m = mo.collect_moments(fx.reg2_points(spark, sf_dir))
    return rounded(spark.createDataFrame(tr.model_rows(mo.ridge_closed_form(m, 1.0)), tr.MODEL_SCHEMA))


def _gram_sql():
    cols = ["label", "x1", "x2", "x3", "x4"]
    parts = [
        f"SELECT {i} AS i, {j} AS j, {o.R(f'sum({cols[i]} * {cols[j]})')} AS value, count(*) AS n FROM p"
        for i in range(5) for j in range(5)
    ]
    return f"WITH p AS ({fx.duck_sql('REG')}) " + " UNION ALL ".join(parts)


@register("gram_moments", _gram_sql())
def gram_moments(spark, sf_dir):
    """Σ v_i v_j for v = (y, x1..x4) over REG, one scan, long form."""
    return rounded(mo.moments_frame(fx.reg_points(spark, sf_dir)))


@register(
    "lipschitz_step",
    f"WITH p AS ({fx.duck_sql('REG2')}), m AS (SELECT sum(x1 * x1) / count(*) AS a, sum(x1 * x2) / count(*) AS b, "
    f"sum(x2 * x2) / count(*) AS c FROM p), e AS (SELECT (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) "
    f"AS l FROM m) SELECT {o.R('l')} AS lipschitz, {o.R('1 / l')} AS step FROM e",
)
def lipschitz_step(spark, sf_dir):
    """Largest eigenvalue of XᵀX/n on REG2 and the step 1/L."""
    m = mo.collect_moments(fx.reg2_points(spark, sf_dir))
    L = mo.lipschitz_constant(m)
    return rounded(spark.createDataFrame([(L, 1.0 / L)], "lipschitz double, step double"))
