"""Scoring and trace analysis (F1-F6) over point, coefficient and trace tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.points import PointSet
from .loss_grad import point_margin


def predict_linear(points: PointSet, weights: Sequence[float], keep: Sequence[str] = ()) -> DataFrame:
    """ŷ = x·w per row of wide or vector points (weights are a parameter-sized literal)."""
    cols = ([points.id] if points.id else []) + list(keep)
    return points.df.select(*cols, F.col(points.label).alias("label"),
                            point_margin(points, weights).alias("prediction"))


def mean_squared_error(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """mean (ŷ − y)², optionally per group."""
    err = (F.col("prediction") - F.col("label"))
    aggs = [(F.sum(err * err) / F.count(F.lit(1))).alias("mse"), F.count(F.lit(1)).alias("n")]
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)


def coefficient_residual(a: DataFrame, b: DataFrame) -> DataFrame:
    """mean (w − w')² over matching (model, class, feature); a missing weight counts as 0."""
    keys = ["model_id", "class_id", "feature_id"]
    j = a.withColumnRenamed("weight", "wa").join(b.withColumnRenamed("weight", "wb"), keys, "full_outer")
    diff = F.coalesce(F.col("wa"), F.lit(0.0)) - F.coalesce(F.col("wb"), F.lit(0.0))
    return j.groupBy("model_id").agg((F.sum(diff * diff) / F.count(F.lit(1))).alias("residual"))


def _with_final(trace: DataFrame, column: str) -> DataFrame:
    """Each row beside ``_final``, the column's value at the last iterate of its run (one narrow row per run)."""
    last = trace.groupBy("run_id").agg(F.max("iter").alias("iter"))
    final = trace.join(last, ["run_id", "iter"], "left_semi").select("run_id", F.col(column).alias("_final"))
    return trace.join(final, "run_id")


def convergence_gap(trace: DataFrame) -> DataFrame:
    """|J(w_t) − J(ŵ)| per iterate, ŵ the last iterate of its run."""
    t = _with_final(trace.select("run_id", "iter", "loss"), "loss")
    return t.select("run_id", "iter", F.abs(F.col("loss") - F.col("_final")).alias("gap"))


def _dist(a: str, b: str):
    sq = F.zip_with(F.col(a), F.col(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def path_distance(trace: DataFrame) -> DataFrame:
    """‖w_t − ŵ‖ per iterate, ŵ the last iterate of its run."""
    t = _with_final(trace.select("run_id", "iter", "weights"), "weights")
    return t.select("run_id", "iter", _dist("weights", "_final").alias("distance"))


def step_norm(trace: DataFrame) -> DataFrame:
    """‖w_t − w_{t−1}‖ per iterate (null at the first), by a join with the iterate before."""
    before = trace.select("run_id", (F.col("iter") + 1).alias("iter"), F.col("weights").alias("_prev"))
    t = trace.select("run_id", "iter", "weights").join(before, ["run_id", "iter"], "left")
    return t.select("run_id", "iter", F.when(F.col("_prev").isNull(), F.lit(None).cast("double"))
                    .otherwise(_dist("weights", "_prev")).alias("step_norm"))
