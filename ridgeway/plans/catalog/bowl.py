"""G1 for a non-margin loss (a quadratic bowl that the table defines) and the four-solver ridge comparison."""

from __future__ import annotations

import numpy as np

from ...functions.losses import BatchLoss
from ...operators import loss_grad as lg
from ...operators import moments as mo
from ...operators.penalties import L1Penalty, L2Penalty
from ...sources import fixtures as fx
from .. import oracle as o
from .. import params as P
from .. import trainers as tr
from .evaluation import SOLVERS4
from .fits import LAMBDA_RIDGE2, _ridge2_sql
from .registry import register, rounded

# --- G1 for a non-margin loss: the lasso example's bowl over a table ------------------------


BOWL_LAMBDAS = (0.05, 0.2, 0.3)  # the last one zeroes coefficients


def bowl_loss(mu) -> BatchLoss:
    """½ ((w − μ)·x)² per row: its mean is the bowl ½ (w − μ)ᵀ (XᵀX/n) (w − μ), a function of w − μ, not of x·w."""
    mu = [float(m) for m in mu]

    def batch(X, y, W):
        r = X @ (W[0] - np.array(mu))
        return float(0.5 * (r @ r)), (X.T @ r)[None, :]

    def columns(W, feats, label):
        r = sum((x * float(w - m) for x, w, m in zip(feats[1:], W[0][1:], mu[1:])), feats[0] * float(W[0][0] - mu[0]))
        return r * r * 0.5, [r * x for x in feats]

    return BatchLoss("quadratic_bowl", batch, column_fn=columns)


def _bowl_path_sql():
    lr = "lr"
    t = f"({lr} * lam)"

    def st(v):
        return f"(CASE WHEN abs({v}) < {t} THEN {o.D(0)} ELSE ({v} - (sign({v}) * {t})) END)"

    data = (
        f"p AS ({fx.duck_sql('REG2')}), s AS (SELECT sum(x1 * x1) / count(*) AS a, sum(x1 * x2) / count(*) AS b, "
        f"sum(x2 * x2) / count(*) AS c, sum(x1 * label) / count(*) AS u, sum(x2 * label) / count(*) AS v FROM p), "
        f"q AS (SELECT a, b, c, (u * c - b * v) / (a * c - b * b) AS m1, (a * v - b * u) / (a * c - b * b) AS m2, "
        f"1.0 / ((a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b)) AS lr FROM s)"
    )
    step = (f"SELECT lam, k, w1, w2, lr, a * (w1 - m1) + b * (w2 - m2) AS g1, b * (w1 - m1) + c * (w2 - m2) AS g2 FROM it, q "
            f"WHERE k < {P.N_ITER} AND (dn IS NULL OR dn >= {o.D(P.TOL)})")
    upd = f"SELECT lam, k, w1, w2, lr, w1 - ({lr} * g1) AS v1, w2 - ({lr} * g2) AS v2 FROM ({step}) a"
    nw = f"SELECT lam, k, w1, w2, {st('v1')} AS n1, {st('v2')} AS n2 FROM ({upd}) b"
    rec = f"SELECT lam, k + 1, n1, n2, sqrt((n1 - w1) * (n1 - w1) + (n2 - w2) * (n2 - w2)) FROM ({nw}) c"
    base = ("SELECT lam, 0, " + o.D(0) + ", " + o.D(0) + ", CAST(NULL AS DOUBLE) FROM (VALUES "
            + ", ".join(f"({o.D(l)})" for l in BOWL_LAMBDAS) + ") L(lam)")
    last = "k = (SELECT max(i2.k) FROM it i2 WHERE i2.lam = it.lam)"
    return (f"WITH RECURSIVE {data}, it(lam, k, w1, w2, dn) AS ({base} UNION ALL {rec}) "
            + " UNION ALL ".join(f"SELECT {o.R('lam')} AS lambda, {j} AS feature_id, {o.R(f'w{j}')} AS weight "
                                 f"FROM it WHERE {last}" for j in (1, 2)))


@register("custom_loss_bowl_lasso", _bowl_path_sql())
def custom_loss_bowl_lasso(spark, sf_dir):
    """G1 + E10: L1 around the bowl that REG2's moments define (μ its least squares), a batch loss over the rows, three λ."""
    pts = fx.reg2_points(spark, sf_dir)
    m = mo.collect_moments(pts)
    loss = bowl_loss(np.linalg.solve(m.xtx, m.xty))
    with lg.SparkEvaluator(pts, loss) as ev:
        fits = tr.proximal_path(ev, np.zeros(2), L1Penalty(), BOWL_LAMBDAS, lr=1.0 / mo.lipschitz_constant(m), lr_decay=False)
    rows = [(lam, j + 1, float(f.weights[j])) for lam, f in zip(BOWL_LAMBDAS, fits) for j in range(2)]
    return rounded(spark.createDataFrame(rows, "lambda double, feature_id int, weight double"))


def _solver_ridge_sql():
    one = _ridge2_sql(o.D(LAMBDA_RIDGE2), "mean", 3)
    head, tail = one.split(" SELECT 0 AS model_id", 1)
    body = "SELECT 0 AS model_id" + tail
    return head + " " + " UNION ALL ".join(
        f"SELECT '{name}' AS solver, feature_id, weight FROM ({body})" for name in SOLVERS4
    )


@register("solver_comparison_ridge", _solver_ridge_sql())
def solver_comparison_ridge(spark, sf_dir):
    """F11 with an oracle: the four solvers on REG2 ridge (λ=0.05) to ‖·‖ < 1e-6 from one moments scan."""
    ev = mo.MomentsEvaluator.from_points(fx.reg2_points(spark, sf_dir))
    pen, lam = L2Penalty(), LAMBDA_RIDGE2
    fits = {
        "gradient_descent": tr.gradient_descent(ev, np.zeros(2), pen, lam, lr=1.0),
        "bfgs": tr.bfgs(ev, np.zeros(2), pen, lam, lr=1.0),
        "proximal": tr.proximal_gradient(ev, np.zeros(2), pen, lam, lr=1.0, lr_decay=False),
        "accelerated_proximal": tr.accelerated_proximal(ev, np.zeros(2), pen, lam, lr=1.0, lr_decay=False),
    }
    rows = [(name, j + 1, float(res.weights[j])) for name, res in fits.items() for j in range(2)]
    return rounded(spark.createDataFrame(rows, "solver string, feature_id int, weight double"), 3)
