"""Penalties and projections over a many-model coefficient table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import penalties as pe
from ...sources import coefficients as co
from ...sources.tables import table
from .. import oracle as o
from .registry import register, rounded

# --- D1-D10, C9: penalties and projections over a many-model coefficient table -----------


COEF_GROUPS = [list(range(8 * g + 1, 8 * g + 9)) for g in range(6)]  # features 49..64 stay free
L1_T = 0.1
L2_T = 0.5
GROUP_T = 0.2

_COEF = (
    "coef AS (SELECT vec_id AS model_id, 0 AS class_id, CAST(generate_subscripts(embedding, 1) AS INTEGER) "
    "AS feature_id, CAST(unnest(embedding) AS DOUBLE) AS weight FROM embeddings), "
    "cg AS (SELECT c.*, CASE WHEN feature_id <= 48 THEN (feature_id - 1) // 8 + 1 END AS group_id FROM coef c)"
)
_KEYS = "model_id, class_id, feature_id"


def _coef(spark, sf_dir):
    return co.embedding_coefficients(spark, sf_dir)


def _groups(spark):
    return pe.groups_frame(spark, COEF_GROUPS)


@register("l2_score", f"WITH {_COEF} SELECT model_id, {o.R('sum(weight * weight) / 2.0')} AS score FROM coef GROUP BY model_id")
def l2_score(spark, sf_dir):
    """½‖w‖² per model, one model per embedding row."""
    return rounded(pe.l2_score(_coef(spark, sf_dir)))


@register("l2_gradient", f"WITH {_COEF} SELECT {_KEYS}, {o.R(f'{o.D(L2_T)} * weight')} AS grad FROM coef")
def l2_gradient(spark, sf_dir):
    """λw per coefficient (λ = 0.5)."""
    return rounded(pe.l2_gradient(_coef(spark, sf_dir), L2_T))


@register("l2_prox", f"WITH {_COEF} SELECT {_KEYS}, {o.R(f'weight / {o.D(1.0 + L2_T)}')} AS weight FROM coef")
def l2_prox(spark, sf_dir):
    """D3: w/(1 + t) per coefficient (t = 0.5)."""
    return rounded(pe.l2_prox(_coef(spark, sf_dir), L2_T))


@register("l1_score", f"WITH {_COEF} SELECT model_id, {o.R('sum(abs(weight))')} AS score FROM coef GROUP BY model_id")
def l1_score(spark, sf_dir):
    """Σ|w| per model."""
    return rounded(pe.l1_score(_coef(spark, sf_dir)))


@register(
    "l1_prox",
    f"WITH {_COEF} SELECT {_KEYS}, {o.R(f'CASE WHEN abs(weight) < {o.D(L1_T)} THEN 0.0 ELSE weight - sign(weight) * {o.D(L1_T)} END')} "
    f"AS weight FROM coef",
)
def l1_prox(spark, sf_dir):
    """Soft threshold at t = 0.1 per coefficient."""
    return rounded(pe.l1_prox(_coef(spark, sf_dir), L1_T))


@register(
    "group_l1_score",
    f"WITH {_COEF}, gn AS (SELECT model_id, class_id, group_id, CASE WHEN group_id IS NULL THEN 0.0 "
    f"ELSE sqrt(sum(weight * weight)) END AS norm FROM cg GROUP BY model_id, class_id, group_id) "
    f"SELECT model_id, {o.R('sum(norm)')} AS score FROM gn GROUP BY model_id",
)
def group_l1_score(spark, sf_dir):
    """Σ_g ‖w_g‖ per model over six groups of eight features (49..64 free)."""
    return rounded(pe.group_l1_score(_coef(spark, sf_dir), _groups(spark)))


def _group_prox_sql(threshold):
    lim = f"{o.D(GROUP_T)} * sqrt(sz)" if threshold == "sqrt_size" else o.D(GROUP_T)
    return (
        f"WITH {_COEF}, w AS (SELECT *, sqrt(sum(weight * weight) OVER (PARTITION BY model_id, class_id, group_id)) "
        f"AS nrm, count(*) OVER (PARTITION BY model_id, class_id, group_id) AS sz FROM cg) "
        f"SELECT {_KEYS}, {o.R(f'CASE WHEN group_id IS NULL THEN weight WHEN nrm <= {lim} THEN 0.0 ELSE weight * ((nrm - {o.D(GROUP_T)}) / nrm) END')} "
        f"AS weight FROM w"
    )


@register("group_l1_prox", _group_prox_sql("exact"))
def group_l1_prox(spark, sf_dir):
    """Group soft threshold at t = 0.2 (exact prox); group norms by a partial groupBy, joined back."""
    return rounded(pe.group_l1_prox(_coef(spark, sf_dir), _groups(spark), GROUP_T, "exact"))


@register("group_l1_prox_sqrt_size", _group_prox_sql("sqrt_size"))
def group_l1_prox_sqrt_size(spark, sf_dir):
    """D7 variant: zero a group when ‖w_g‖ ≤ t·√|g| (the modelled library's threshold)."""
    return rounded(pe.group_l1_prox(_coef(spark, sf_dir), _groups(spark), GROUP_T, "sqrt_size"))


@register("box_membership", f"WITH {_COEF} SELECT model_id, bool_and(weight BETWEEN -0.3 AND 0.3) AS inside FROM coef GROUP BY model_id")
def box_membership(spark, sf_dir):
    """Whether all weights of a model lie in [-0.3, 0.3]."""
    return pe.box_membership(_coef(spark, sf_dir), -0.3, 0.3)


@register("box_projection", f"WITH {_COEF} SELECT {_KEYS}, {o.R('greatest(0.0, least(1.0, weight))')} AS weight FROM coef")
def box_projection(spark, sf_dir):
    """Clip every weight to [0, 1]."""
    return rounded(pe.box_projection(_coef(spark, sf_dir)))


@register(
    "vector_norms",
    f"WITH {_COEF} SELECT model_id, {o.R('sqrt(sum(weight * weight))')} AS l2_norm, {o.R('sum(abs(weight))')} AS l1_norm, "
    f"{o.R('max(abs(weight))')} AS max_abs FROM coef GROUP BY model_id",
)
def vector_norms(spark, sf_dir):
    """L2, L1 and max-magnitude norm of every model."""
    return rounded(pe.vector_norms(_coef(spark, sf_dir)))


@register(
    "group_norms",
    f"WITH {_COEF} SELECT model_id, class_id, group_id, {o.R('sqrt(sum(weight * weight))')} AS norm, "
    f"CAST(count(*) AS INTEGER) AS size FROM cg WHERE group_id IS NOT NULL GROUP BY model_id, class_id, group_id",
)
def group_norms(spark, sf_dir):
    """L2 norm and size of every feature group of every model."""
    return rounded(pe.group_norms(_coef(spark, sf_dir), _groups(spark)))


@register(
    "stack_weights",
    f"WITH {_COEF} SELECT model_id, class_id, feature_id, {o.R('weight')} AS weight FROM coef "
    f"UNION ALL SELECT model_id, class_id, feature_id + 64, {o.D(0)} FROM coef "
    f"UNION ALL SELECT model_id, class_id, 129, {o.D(1)} FROM coef WHERE feature_id = 1",
)
def stack_weights(spark, sf_dir):
    """Per model, [its weights | as many zeros | bias 1] stacked with offset feature ids."""
    c = active = _coef(spark, sf_dir)
    zeros = active.select("model_id", "class_id", "feature_id", F.lit(0.0).alias("weight"))
    bias = c.where(F.col("feature_id") == 1).select("model_id", "class_id", "feature_id", F.lit(1.0).alias("weight"))
    return rounded(co.stack_weights([active, zeros, bias]))
