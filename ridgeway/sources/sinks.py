"""Model and trace sinks (A6/A7): plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MODEL_COLUMNS = ["model_id", "class_id", "feature_id", "weight"]
TRACE_COLUMNS = ["run_id", "iter", "loss", "eta", "norm", "eval_point", "weights"]


def write_model(model: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a coefficient table; partitioned by nothing (it is parameter-sized)."""
    model.select(*MODEL_COLUMNS).coalesce(1).write.mode(mode).parquet(path)
    return path


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*MODEL_COLUMNS)


def write_trace(trace: DataFrame, path: str, mode: str = "append") -> str:
    """Append a fit's trace rows (one row per iterate) to a trace table."""
    trace.select(*TRACE_COLUMNS).coalesce(1).write.mode(mode).parquet(path)
    return path


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*TRACE_COLUMNS)
