"""One call to fit a model on a point table.

``fit`` picks the evaluator (second moments for squared loss, the Column
aggregate or Arrow partials otherwise), runs the chosen trainer and releases
the cached points. It is the counterpart of ``optimizer.optimize(init,
dataset, loss, penalty, lam)`` in the modelled library.
"""

from __future__ import annotations

import numpy as np

from ..functions.losses import Loss, get_loss
from ..operators.evaluation_log import LoggedEvaluator
from ..operators.loss_grad import SparkEvaluator
from ..operators.moments import MAX_DRIVER_D, MomentsEvaluator
from ..operators.penalties import Penalty, Projector
from ..sources.points import PointSet
from . import trainers as tr

SOLVERS = ("gradient_descent", "bfgs", "proximal", "accelerated_proximal", "projected")


def fit(
    points: PointSet,
    loss: str | Loss,
    penalty: Penalty | None = None,
    lam: float = 0.0,
    solver: str = "proximal",
    init=None,
    projector: Projector | None = None,
    strategy: str = "auto",
    resume_path: str | None = None,
    write_every: int = 20,
    **options,
) -> tr.FitResult:
    """Fit weights of shape (d,) or (C, d) by one of ``SOLVERS``.

    ``options`` go to the trainer (``lr``, ``lr_decay``, ``n_iter``, ``tol``,
    ``c1``, ``rho``, ``batch``, ``momentum``...). Squared loss is fitted from the
    moments (one scan) unless ``strategy`` names a row strategy or the moment
    matrix would outgrow the driver; then every step scans the rows.

    With ``resume_path`` every evaluation is written there as the fit runs, and a
    fit that was stopped goes on where it was when called again with the same
    arguments (see ``operators.evaluation_log``); a finished one is read back
    without a step.
    """
    loss = get_loss(loss)
    C = loss.n_margins(points.n_classes)
    w0 = np.zeros((C, points.d)) if init is None else np.asarray(init, dtype=float)
    if C == 1 and w0.ndim == 2:
        w0 = w0[0]
    if loss.name == "squared" and strategy == "auto" and points.d <= MAX_DRIVER_D:
        ev = MomentsEvaluator.from_points(points)
    else:
        ev = SparkEvaluator(points, loss, strategy=strategy)
    if resume_path is not None:
        ev = LoggedEvaluator(ev, points.df.sparkSession, resume_path, write_every)
    try:
        if solver == "gradient_descent":
            return tr.gradient_descent(ev, w0, penalty, lam, **options)
        if solver == "bfgs":
            return tr.bfgs(ev, w0, penalty, lam, **options)
        if solver == "proximal":
            return tr.proximal_gradient(ev, w0, penalty, lam, **options)
        if solver == "accelerated_proximal":
            return tr.accelerated_proximal(ev, w0, penalty, lam, **options)
        if solver == "projected":
            if projector is None:
                raise ValueError("the projected solver needs a projector")
            return tr.projected_gradient(ev, w0, projector, **options)
        raise ValueError(f"unknown solver {solver!r}; choose from {SOLVERS}")
    finally:
        ev.close()
