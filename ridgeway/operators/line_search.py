"""Batched Armijo line search as one query.

All candidate steps η ρ^m (m = 0..M−1) are scored in a single aggregate over
the point table; the accepted step is the smallest m whose objective meets
the Armijo bound, which is the step a one-at-a-time backtracking search finds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.losses import get_loss
from ..sources.points import PointSet
from .loss_grad import COLUMN_FORM_MAX_OUTPUTS, SparkEvaluator, as_matrix, models_frame, point_margin
from .penalties import NoPenalty


def _scored(points: PointSet, loss, W: np.ndarray, direction: np.ndarray, etas: list[float]) -> DataFrame:
    """(m, mean_loss) of the steps: a row's margins at W + η D are z + η dz, so two numbers per margin serve all candidates."""
    C = len(W)
    z = [point_margin(points, W[c]).alias(f"_z{c}") for c in range(C)]
    dz = [point_margin(points, direction[c]).alias(f"_dz{c}") for c in range(C)]
    rows = points.df.select(F.col(points.label).alias("_y"), *z, *dz)
    out = None
    for start in range(0, len(etas), COLUMN_FORM_MAX_OUTPUTS):
        part = list(enumerate(etas))[start : start + COLUMN_FORM_MAX_OUTPUTS]
        sums = [
            F.sum(loss.pointwise([F.col(f"_z{c}") + F.lit(float(e)) * F.col(f"_dz{c}") for c in range(C)], F.col("_y"))[0]).alias(f"l{m}")
            for m, e in part
        ]
        each = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), (F.col(f"l{m}") / F.col("n")).alias("mean_loss")) for m, _ in part)))
        one = rows.agg(F.count(F.lit(1)).alias("n"), *sums).select(each.alias("e")).select("e.m", "e.mean_loss")
        out = one if out is None else out.unionByName(one)
    return out


def line_search_table(
    points: PointSet,
    loss,
    W,
    penalty=None,
    lam: float = 0.0,
    eta0: float = 1.0,
    rho: float = 0.9,
    c1: float = 0.3,
    candidates: int = 16,
) -> DataFrame:
    """Candidates ``(m, eta, objective, bound, armijo, chosen)`` for steepest descent at W.

    Two jobs: the gradient at W, then every candidate's loss in one aggregate,
    in the space of margins: a row's cost per candidate doesn't depend on d.
    """
    loss = get_loss(loss)
    penalty = penalty or NoPenalty()
    if not penalty.differentiable:
        raise ValueError("line search needs a differentiable penalty")
    with SparkEvaluator(points, loss, persist=False) as ev:
        C = ev.n_margins
        Wm = as_matrix(W, C, points.d)
        w = Wm if C > 1 else Wm[0]
        n, total, G = ev.evaluate(Wm)
    G = G / n
    grad = (G if C > 1 else G[0]) + lam * np.asarray(penalty.grad(w))
    F0 = total / n + lam * penalty.score(w)
    direction = -grad
    slope = float(np.sum(grad * direction))
    etas = [eta0 * rho**m for m in range(candidates)]
    cands = np.array([w + e * direction for e in etas]).reshape(candidates, C, points.d)
    if hasattr(loss, "batch_fn"):  # not a function of margins
        scored = models_frame(points, loss, cands).select(F.col("model").alias("m"), (F.col("loss_sum") / F.col("n")).alias("mean_loss"))
    else:
        scored = _scored(points, loss, Wm, np.asarray(direction, float).reshape(C, points.d), etas)
    pen = F.create_map(*[x for m in range(candidates)
                         for x in (F.lit(m), F.lit(float(lam * penalty.score(cands[m] if C > 1 else cands[m][0]))))])
    eta = F.create_map(*[x for m, e in enumerate(etas) for x in (F.lit(m), F.lit(float(e)))])
    bound = F.create_map(*[x for m, e in enumerate(etas) for x in (F.lit(m), F.lit(float(F0 + c1 * e * slope)))])
    out = scored.select(
        F.col("m").cast("int").alias("m"),
        eta[F.col("m")].alias("eta"),
        (F.col("mean_loss") + pen[F.col("m")]).alias("objective"),
        bound[F.col("m")].alias("bound"),
    ).withColumn("armijo", F.col("objective") <= F.col("bound"))
    # a global window, but over the `candidates` rows only (a parameter, not data)
    first = F.min(F.when(F.col("armijo"), F.col("m"))).over(Window.partitionBy())
    return out.withColumn("chosen", F.coalesce(F.col("m") == first, F.lit(False)))
