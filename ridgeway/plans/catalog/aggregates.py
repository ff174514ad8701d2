"""loss/gradient aggregates for the four losses, and the regularised objective."""

from __future__ import annotations

from ...operators import loss_grad as lg
from ...operators.penalties import L2Penalty
from ...sources import fixtures as fx
from .. import oracle as o
from .. import params as P
from .registry import register, rounded

# --- C1-C4: loss / gradient aggregates ------------------------------------------------

_LOSS_CASES = {
    "softmax_wide": ("SM10", P.w_multi(10, 64, 0.01, 0.005)),
    "logistic": ("BIN", [list(P.W_BIN)]),
    "hinge": ("BIN", [list(P.W_HINGE)]),
    "softmax": ("MULTI", P.w_multi()),
    "squared": ("REG", [list(P.W_REG)]),
}


def _loss_grad_query(case: str, reduce: str):
    fixture, W = _LOSS_CASES[case]
    loss = case.replace("_wide", "")

    def run(spark, sf_dir):
        pts = fx.FIXTURES[fixture](spark, sf_dir)
        return rounded(lg.loss_grad_long(pts, loss, W, reduce=reduce))

    wide = " (C·d = 640 sums, Arrow partials)" if case.endswith("_wide") else ""
    run.__doc__ = (f"{'C2' if reduce == 'mean' else 'C3'}: {'mean' if reduce == 'mean' else 'summed'} {loss} "
                   f"loss and gradient over {fixture}{wide}")
    return run


for _case, (_fix, _W) in _LOSS_CASES.items():
    for _red in ("mean", "sum"):
        if _case.endswith("_wide") and _red == "sum":
            continue
        register(f"{_red}_loss_grad_{_case}", o.loss_grad_long(_fix, _case.replace("_wide", ""), _W, reduce=_red))(
            _loss_grad_query(_case, _red)
        )


@register("point_count", f"SELECT count(*) AS n FROM ({fx.duck_sql('BIN')})")
def point_count(spark, sf_dir):
    """Number of labelled points in BIN."""
    return lg.point_count(fx.bin_points(spark, sf_dir))


def _reg_objective_sql():
    pen = L2Penalty()
    W = [list(P.W_BIN)]
    return o.loss_grad_long(
        "BIN", "logistic", W, "mean", P.LAMBDA_L2 * pen.score(W[0]), [[P.LAMBDA_L2 * w for w in W[0]]]
    )


@register("regularized_objective", _reg_objective_sql())
def regularized_objective(spark, sf_dir):
    """C4: mean logistic loss + λ·½‖w‖² and its gradient over BIN."""
    pts = fx.bin_points(spark, sf_dir)
    return rounded(lg.loss_grad_long(pts, "logistic", [list(P.W_BIN)], "mean", L2Penalty(), P.LAMBDA_L2))
