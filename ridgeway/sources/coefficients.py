"""Coefficient tables ``(model_id, class_id, feature_id, weight)``.

Besides the fitted models of the trainers, a table of many models can be read
from data: every embedding row is one weight vector (model_id = vec_id), so
the penalty and projection operators run over a table that grows with the
input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def coefficients_from_array(df: DataFrame, id_col: str, array_col: str, class_id: int = 0) -> DataFrame:
    """One model per row: element k of the array becomes feature k+1."""
    return df.select(
        F.col(id_col).cast("bigint").alias("model_id"),
        F.lit(class_id).cast("int").alias("class_id"),
        F.posexplode(array_col).alias("pos", "w"),
    ).select("model_id", "class_id", (F.col("pos") + 1).cast("int").alias("feature_id"),
             F.col("w").cast("double").alias("weight"))


def embedding_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding vector as a 64-weight model."""
    return coefficients_from_array(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def stack_weights(blocks: Sequence[DataFrame], sizes: Sequence[int] | None = None) -> DataFrame:
    """Concatenate coefficient blocks feature-wise, offsetting feature ids.

    Block k's features follow those of blocks 0..k-1. ``sizes`` gives each
    block's feature count; without it the largest feature id of each block is
    read (one small aggregate per block).
    """
    out = None
    offset = 0
    for k, b in enumerate(blocks):
        size = sizes[k] if sizes is not None else (b.agg(F.max("feature_id")).first()[0] or 0)
        shifted = b.select("model_id", "class_id", (F.col("feature_id") + F.lit(offset)).cast("int").alias("feature_id"),
                           "weight")
        out = shifted if out is None else out.unionByName(shifted)
        offset += int(size)
    return out
