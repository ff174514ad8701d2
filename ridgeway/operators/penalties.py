"""Penalties, proximal steps and box projection.

Two faces of the same formulas:

* driver objects (``L2Penalty``, ``L1Penalty``, ``GroupL1Penalty``,
  ``BoxProjector``) act on the parameter-sized weight array inside a fit;
* table operators act on a coefficient table
  ``(model_id, class_id, feature_id, weight)`` holding any number of models,
  reduced per model (and feature group) by partially aggregated ``groupBy``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- driver-side protocol (G2 / G3) -----------------------------------------------


class Penalty:
    """``score(w)``, ``grad(w)``, ``prox(v, t)`` and ``differentiable``."""

    differentiable = True
    name = "penalty"

    def score(self, w) -> float:
        raise NotImplementedError

    def grad(self, w):
        raise NotImplementedError

    def prox(self, v, t: float):
        raise NotImplementedError


class NoPenalty(Penalty):
    name = "none"

    def score(self, w):
        return 0.0

    def grad(self, w):
        return np.zeros_like(np.asarray(w, dtype=float))

    def prox(self, v, t):
        return np.asarray(v, dtype=float).copy()


class L2Penalty(Penalty):
    """½‖w‖² (Frobenius for matrices), gradient w, prox v/(1+t).

    ``matrix_score='column_sums'`` scores a (C, d) matrix as ½ Σ_c (Σ_j w_cj)², the
    value the modelled library reports (its gradient stays W, so the two
    disagree); vectors score the same either way.
    """

    name = "l2"

    def __init__(self, matrix_score: str = "frobenius"):
        if matrix_score not in ("frobenius", "column_sums"):
            raise ValueError("matrix_score must be 'frobenius' or 'column_sums'")
        self.matrix_score = matrix_score

    def score(self, w):
        w = np.asarray(w, dtype=float)
        if w.ndim == 2 and self.matrix_score == "column_sums":
            return float((w.sum(axis=1) ** 2).sum() / 2.0)
        return float((w * w).sum() / 2.0)

    def grad(self, w):
        return np.asarray(w, dtype=float).copy()

    def prox(self, v, t):
        return np.asarray(v, dtype=float) / (1.0 + t)


class L1Penalty(Penalty):
    """Σ|w|; soft threshold; not differentiable."""

    name = "l1"
    differentiable = False

    def score(self, w):
        return float(np.abs(np.asarray(w, dtype=float)).sum())

    def grad(self, w):
        raise ValueError("the L1 penalty is not differentiable; use a proximal trainer")

    def prox(self, v, t):
        v = np.asarray(v, dtype=float)
        return np.where(np.abs(v) < t, 0.0, v - np.sign(v) * t)


class GroupL1Penalty(Penalty):
    """Σ_g ‖w_g‖₂ over index groups; features in no group are free.

    ``threshold='exact'`` zeroes a group when ‖v_g‖ ≤ t (the exact prox);
    ``threshold='sqrt_size'`` zeroes it when ‖v_g‖ ≤ t·√|g| but still shrinks
    by t otherwise, as the modelled library does.
    """

    name = "group_l1"
    differentiable = False

    def __init__(self, groups: Sequence[Sequence[int]], threshold: str = "exact"):
        if threshold not in ("exact", "sqrt_size"):
            raise ValueError("threshold must be 'exact' or 'sqrt_size'")
        self.groups = [list(g) for g in groups]
        self.threshold = threshold

    def score(self, w):
        w = np.asarray(w, dtype=float).reshape(-1)
        return float(sum(math.sqrt(float((w[g] ** 2).sum())) for g in self.groups))

    def grad(self, w):
        raise ValueError("the group-L1 penalty is not differentiable; use a proximal trainer")

    def prox(self, v, t):
        v = np.asarray(v, dtype=float)
        shape = v.shape
        v = v.reshape(-1)
        out = v.copy()
        for g in self.groups:
            norm = math.sqrt(float((v[g] ** 2).sum()))
            limit = t * math.sqrt(len(g)) if self.threshold == "sqrt_size" else t
            if norm <= limit:
                out[g] = 0.0
            else:
                out[g] = v[g] * ((norm - t) / norm)
        return out.reshape(shape)


class Projector:
    """``contains(w)`` and ``project(w)``."""

    def contains(self, w) -> bool:
        raise NotImplementedError

    def project(self, w):
        raise NotImplementedError


class BoxProjector(Projector):
    """The box [lo, hi] in every coordinate (default [0, 1])."""

    def __init__(self, lo: float = 0.0, hi: float = 1.0):
        self.lo, self.hi = lo, hi

    def contains(self, w):
        w = np.asarray(w, dtype=float)
        return bool(((w >= self.lo) & (w <= self.hi)).all())

    def project(self, w):
        return np.clip(np.asarray(w, dtype=float), self.lo, self.hi)

    def column(self, c: Column) -> Column:
        return F.greatest(F.lit(float(self.lo)), F.least(F.lit(float(self.hi)), c))


def require_differentiable(penalty: Penalty) -> None:
    """Smooth trainers refuse a non-differentiable penalty up front."""
    if not penalty.differentiable:
        raise ValueError(f"penalty '{penalty.name}' is not differentiable")


# --- Column functions ----------------------------------------------------------------


def soft_threshold(v: Column, t: Column | float) -> Column:
    """0 where |v| < t, else v - sign(v) t."""
    tc = t if isinstance(t, Column) else F.lit(float(t))
    return F.when(F.abs(v) < tc, F.lit(0.0)).otherwise(v - F.signum(v) * tc)


def box_clip(v: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), v))


# --- table operators over (model_id, class_id, feature_id, weight) -------------------

MODEL_KEYS = ["model_id", "class_id", "feature_id"]
MAX_BROADCAST_GROUP_ROWS = 1_000_000  # of (feature_id, group_id): 12 MB


def l2_score(coef: DataFrame) -> DataFrame:
    """Per model ½ Σ w²."""
    return coef.groupBy("model_id").agg((F.sum(F.col("weight") * F.col("weight")) / 2.0).alias("score"))


def l2_gradient(coef: DataFrame, lam: float = 1.0) -> DataFrame:
    """λ w per coefficient."""
    return coef.select(*MODEL_KEYS, (F.lit(float(lam)) * F.col("weight")).alias("grad"))


def l2_prox(coef: DataFrame, t: float) -> DataFrame:
    """D3: w / (1 + t)."""
    return coef.select(*MODEL_KEYS, (F.col("weight") / (1.0 + float(t))).alias("weight"))


def l1_score(coef: DataFrame) -> DataFrame:
    """Per model Σ |w|."""
    return coef.groupBy("model_id").agg(F.sum(F.abs("weight")).alias("score"))


def l1_prox(coef: DataFrame, t: float) -> DataFrame:
    """Soft threshold at t."""
    return coef.select(*MODEL_KEYS, soft_threshold(F.col("weight"), t).alias("weight"))


def groups_frame(spark, groups: Mapping[int, int] | Sequence[Sequence[int]]) -> DataFrame:
    """Feature-to-group table ``(feature_id, group_id)``; absent features are free.

    ``groups`` is either {feature_id: group_id} or a list of feature-id lists
    (group ids 1, 2, ...). It is parameter-sized (one row per feature).
    """
    if isinstance(groups, Mapping):
        rows = [(int(f), int(g)) for f, g in groups.items()]
    else:
        rows = [(int(f), gi + 1) for gi, g in enumerate(groups) for f in g]
    return spark.createDataFrame(rows, "feature_id int, group_id int")


def _with_groups(coef: DataFrame, groups: DataFrame) -> DataFrame:
    """Each coefficient with its group. The group table is broadcast only where counted to be small; else the join shuffles."""
    small = groups.limit(MAX_BROADCAST_GROUP_ROWS + 1).count() <= MAX_BROADCAST_GROUP_ROWS
    return coef.join(F.broadcast(groups) if small else groups, "feature_id", "left")


def group_l1_score(coef: DataFrame, groups: DataFrame) -> DataFrame:
    """Per model Σ_g ‖w_g‖₂ over grouped features (free features add nothing)."""
    g = _with_groups(coef, groups)
    norms = g.groupBy("model_id", "class_id", "group_id").agg(
        F.when(F.col("group_id").isNull(), F.lit(0.0))
        .otherwise(F.sqrt(F.sum(F.col("weight") * F.col("weight"))))
        .alias("norm")
    )
    # the free features form a null group of norm 0, so every model keeps a row
    return norms.groupBy("model_id").agg(F.sum("norm").alias("score"))


def group_l1_prox(coef: DataFrame, groups: DataFrame, t: float, threshold: str = "exact") -> DataFrame:
    """Group soft threshold.

    Group norms come from a ``groupBy`` (partial aggregation map-side, so a
    group holding a third of all coefficients still reduces in parallel) and
    are joined back on (model, class, group). AQE turns the join into a
    broadcast when the norm table is small and splits a skewed key otherwise;
    no window puts a whole group in one task.
    """
    g = _with_groups(coef, groups)
    keys = ["model_id", "class_id", "group_id"]
    norms = (
        g.where(F.col("group_id").isNotNull())
        .groupBy(*keys)
        .agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"), F.count(F.lit(1)).alias("_size"))
    )
    j = g.join(norms, keys, "left")
    limit = F.lit(float(t)) * F.sqrt(F.col("_size").cast("double")) if threshold == "sqrt_size" else F.lit(float(t))
    shrunk = F.col("weight") * ((F.col("_norm") - float(t)) / F.col("_norm"))
    return j.select(
        *MODEL_KEYS,
        F.when(F.col("group_id").isNull(), F.col("weight"))
        .when(F.col("_norm") <= limit, F.lit(0.0))
        .otherwise(shrunk)
        .alias("weight"),
    )


def box_membership(coef: DataFrame, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Per model, whether every weight lies in [lo, hi]."""
    return coef.groupBy("model_id").agg(
        F.bool_and(F.col("weight").between(float(lo), float(hi))).alias("inside")
    )


def box_projection(coef: DataFrame, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Clip every weight to [lo, hi]."""
    return coef.select(*MODEL_KEYS, box_clip(F.col("weight"), lo, hi).alias("weight"))


def vector_norms(coef: DataFrame) -> DataFrame:
    """Per model L2 norm, L1 norm and largest magnitude of the weights."""
    return coef.groupBy("model_id").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("l2_norm"),
        F.sum(F.abs("weight")).alias("l1_norm"),
        F.max(F.abs("weight")).alias("max_abs"),
    )


def group_norms(coef: DataFrame, groups: DataFrame) -> DataFrame:
    """Per (model, class, group) L2 norm and group size."""
    g = _with_groups(coef, groups).where(F.col("group_id").isNotNull())
    return g.groupBy("model_id", "class_id", "group_id").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
        F.count(F.lit(1)).cast("int").alias("size"),
    )
