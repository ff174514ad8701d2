"""Penalty operators for row-local coefficient tables (one model per row).

When each model's weights arrive as one array column, norms, scores and the
group prox are computed inside the row. There is no explode, no grouping and
no shuffle, whatever the number of models; a model is never split across
tasks. The vector length d is fixed when the job is built (read from one row
and asserted on every row), so every expression indexes the array directly
and stays in whole-stage codegen; no per-element lambdas.

The long-form operators in ``penalties`` remain the general case (weights
from several rows, or from anywhere).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_D = 4096  # unrolled expressions per row; longer vectors belong in the long form


@dataclass(frozen=True)
class CoefRows:
    """``df``: (model_id, class_id, weights array<double>) with ``d`` weights per row."""

    df: DataFrame
    d: int

    def w(self, j: int) -> Column:
        """Weight j (1-based feature id)."""
        return F.col("weights")[j - 1]


def coefficient_rows(df: DataFrame, id_col: str, array_col: str, d: int | None = None, class_id: int = 0) -> CoefRows:
    """One model per row. ``d`` defaults to the length of one row's array (a one-row job);
    any row of another length fails the job."""
    if d is None:
        first = df.select(F.size(array_col).alias("d")).first()
        d = int(first["d"]) if first is not None else 0
    if d > MAX_D:
        raise ValueError(f"{d} weights per row; use the long-form operators beyond {MAX_D}")
    arr = F.col(array_col).cast("array<double>")
    checked = F.when(F.size(arr) == d, arr).otherwise(
        F.raise_error(F.lit(f"every coefficient array must hold {d} weights")).cast("array<double>"))
    out = df.select(
        F.col(id_col).cast("bigint").alias("model_id"),
        F.lit(class_id).cast("int").alias("class_id"),
        checked.alias("weights"),
    )
    return CoefRows(out, d)


def _sum(terms: Sequence[Column]) -> Column:
    acc = terms[0]
    for t in terms[1:]:
        acc = acc + t
    return acc


def l2_score_rows(rows: CoefRows) -> DataFrame:
    """D1 per row: ½ Σ w²."""
    s = _sum([rows.w(j) * rows.w(j) for j in range(1, rows.d + 1)])
    return rows.df.select("model_id", (s / 2.0).alias("score"))


def l1_score_rows(rows: CoefRows) -> DataFrame:
    """D4 per row: Σ |w|."""
    return rows.df.select("model_id", _sum([F.abs(rows.w(j)) for j in range(1, rows.d + 1)]).alias("score"))


def vector_norms_rows(rows: CoefRows) -> DataFrame:
    """C9 per row: L2 norm, L1 norm and largest magnitude."""
    ws = [rows.w(j) for j in range(1, rows.d + 1)]
    mx = F.greatest(*[F.abs(x) for x in ws]) if len(ws) > 1 else F.abs(ws[0])
    return rows.df.select(
        "model_id",
        F.sqrt(_sum([x * x for x in ws])).alias("l2_norm"),
        _sum([F.abs(x) for x in ws]).alias("l1_norm"),
        mx.alias("max_abs"),
    )


def box_membership_rows(rows: CoefRows, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """D9 per row: all weights in [lo, hi]."""
    inside = None
    for j in range(1, rows.d + 1):
        c = rows.w(j).between(float(lo), float(hi))
        inside = c if inside is None else inside & c
    return rows.df.select("model_id", inside.alias("inside"))


def _group_norm(rows: CoefRows, g: Sequence[int]) -> Column:
    return F.sqrt(_sum([rows.w(j) * rows.w(j) for j in g]))


def group_norms_rows(rows: CoefRows, groups: Sequence[Sequence[int]]) -> DataFrame:
    """C9 per row and group: ``(model_id, class_id, group_id, norm, size)``."""
    entries = [
        F.struct(F.lit(gi + 1).alias("group_id"), _group_norm(rows, g).alias("norm"), F.lit(len(g)).alias("size"))
        for gi, g in enumerate(groups)
    ]
    # explode_outer: the array is never empty, and the plain generator would make the
    # optimizer add a size(array(...)) > 0 filter that evaluates every norm twice
    return rows.df.select("model_id", "class_id", F.explode_outer(F.array(*entries)).alias("e")).select(
        "model_id", "class_id", "e.group_id", "e.norm", "e.size")


def group_l1_score_rows(rows: CoefRows, groups: Sequence[Sequence[int]]) -> DataFrame:
    """D6 per row: Σ_g ‖w_g‖ (features in no group add nothing)."""
    return rows.df.select("model_id", _sum([_group_norm(rows, g) for g in groups]).alias("score"))


def group_l1_prox_rows(rows: CoefRows, groups: Sequence[Sequence[int]], t: float, threshold: str = "exact") -> CoefRows:
    """D7 per row: group soft threshold, features in no group copied.

    Group norms come from the row itself, so a model with one huge group is
    handled by the task that reads it, like any other.
    """
    tl = F.lit(float(t))
    factors = []
    for gi, g in enumerate(groups):
        nrm = _group_norm(rows, g)
        limit = tl * F.sqrt(F.lit(float(len(g)))) if threshold == "sqrt_size" else tl
        # one shrink factor per group: 0 at or below the threshold, (‖w_g‖ − t)/‖w_g‖ above
        factors.append(F.when(nrm <= limit, F.lit(0.0)).otherwise((nrm - tl) / nrm).alias(f"_s{gi}"))
    scaled = rows.df.select("*", *factors)
    out = [rows.w(j) for j in range(1, rows.d + 1)]
    for gi, g in enumerate(groups):
        for j in g:
            out[j - 1] = rows.w(j) * F.col(f"_s{gi}")
    return CoefRows(scaled.select("model_id", "class_id", F.array(*out).alias("weights")), rows.d)


def to_long(rows: CoefRows) -> DataFrame:
    """Back to the long coefficient form ``(model_id, class_id, feature_id, weight)``.

    ``posexplode_outer``: every array holds exactly d ≥ 1 weights, and the plain
    generator would make the optimizer infer a size(weights) > 0 filter with the
    whole array expression copied into it.
    """
    return rows.df.select("model_id", "class_id", F.posexplode_outer("weights").alias("pos", "weight")).select(
        "model_id", "class_id", (F.col("pos") + 1).cast("int").alias("feature_id"), "weight")
