"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
