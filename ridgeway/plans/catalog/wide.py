"""Wide variants (Arrow moments and gradients) and the logistic λ path."""

from __future__ import annotations

import numpy as np

from ...operators import loss_grad as lg
from ...operators import moments as mo
from ...operators.penalties import GroupL1Penalty, L1Penalty, L2Penalty
from ...sources import fixtures as fx
from .. import oracle as o
from .. import params as P
from .. import trainers as tr
from .fits import GROUP_LR, _model
from .registry import register, rounded

# --- wide variants: Arrow moments (d = 65) and Arrow gradients (C·d = 640) ------------------

GRP64_GROUPS = [list(range(16 * g + 1, 16 * g + 17)) for g in range(4)]
LAMBDA_WIDE = 0.06
_GRP64_FIT = o.FitSQL("GRP", "squared", 1, 65, P.N_ITER, [[0.0] * 65], "prox_group", lam=LAMBDA_WIDE, lr=GROUP_LR,
                      groups=GRP64_GROUPS, data="moments", accelerated=True)


@register("fit_group_lasso_wide", _GRP64_FIT.model_sql())
def fit_group_lasso_wide(spark, sf_dir):
    """E11 on GRP64: all 64 embedding elements + bias, 4 groups of 16, to ‖Δw‖ < 1e-6; moments by Arrow partials."""
    ev = mo.MomentsEvaluator.from_points(fx.grp_points(spark, sf_dir))
    pen = GroupL1Penalty([[j - 1 for j in g] for g in GRP64_GROUPS])
    res = tr.accelerated_proximal(ev, np.zeros(65), pen, LAMBDA_WIDE, lr=GROUP_LR, lr_decay=False)
    return _model(spark, res)


LR_SM10 = 40.0  # below 1/L of the mean softmax loss on SM10
_SM10_FIT = o.FitSQL("SM10", "softmax", 10, 64, P.N_ITER, [[0.0] * 64] * 10, "prox_l2", lam=P.LAMBDA_L2, lr=LR_SM10)


@register("fit_softmax_wide", _SM10_FIT.model_sql())
def fit_softmax_wide(spark, sf_dir):
    """E13 on SM10: ten-class softmax + L2 over 64 elements, proximal steps to ‖Δw‖ < 1e-6, gradients as Arrow partials."""
    ev = lg.SparkEvaluator(fx.sm10_points(spark, sf_dir), "softmax", strategy="arrow")
    try:
        res = tr.proximal_gradient(ev, np.zeros((10, 64)), L2Penalty(), P.LAMBDA_L2, lr=LR_SM10, lr_decay=False)
    finally:
        ev.close()
    return _model(spark, res)


LAMBDAS_BIN2 = (0.005, 0.02, 0.08, 0.12)  # the larger ones zero coefficients
LR_BIN2 = 4.0
_LOGIT_PATH = o.FitSQL("BIN2", "logistic", 1, 2, P.N_ITER, [[0.0, 0.0]], "prox_l1", lr=LR_BIN2,
                       lambdas=list(LAMBDAS_BIN2))


@register(
    "lambda_path_logistic",
    _LOGIT_PATH.cte() + " " + " UNION ALL ".join(
        f"SELECT {o.R('lam')} AS lambda, {j + 1} AS feature_id, {o.R(f'w_0_{j + 1}')} AS weight "
        f"FROM it WHERE {_LOGIT_PATH.last()}" for j in range(2)
    ),
)
def lambda_path_logistic(spark, sf_dir):
    """E10 for a non-quadratic loss: L1 logistic on BIN2 for four λ to ‖Δw‖ < 1e-6, all λ scored in one job per step."""
    ev = lg.SparkEvaluator(fx.bin2_points(spark, sf_dir), "logistic")
    try:
        fits = tr.proximal_path(ev, np.zeros(2), L1Penalty(), LAMBDAS_BIN2, lr=LR_BIN2, lr_decay=False)
    finally:
        ev.close()
    rows = [(lam, j + 1, float(f.weights[j])) for lam, f in zip(LAMBDAS_BIN2, fits) for j in range(2)]
    return rounded(spark.createDataFrame(rows, "lambda double, feature_id int, weight double"))
