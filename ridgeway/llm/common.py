"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = 250) -> None:
    """Fewer rows per Arrow batch where the session has Spark's default: the rows here are whole texts.

    A batch is held by the JVM and by the Python worker at once, so its size
    bounds what a task needs beside the heap.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(rows))


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors and cuts lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The frame written as Parquet in the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: Column | str, folds: int = 5) -> Column:
    """True where crc32 of the id's decimal text leaves remainder 0 (null ids count as held out)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds == 0, F.lit(True))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for read-only tables built once.

    Functions of this library travel by value, so their module globals start
    empty in every task; this one hangs on a module that the worker imports.
    """
    import pyspark

    return pyspark.__dict__.setdefault("_ridgeway_worker_cache", {})


def sum_vectors(parts: DataFrame, size: int, mergers: int = 32):
    """Sum of packed float64 vectors (column ``v``), one per task, in two steps.

    ``mergers`` tasks each add up their share as a stream; the driver adds
    ``mergers`` vectors of ``size`` numbers, whatever the number of tasks.
    """
    import numpy as np
    import pyarrow as pa

    def merge(batches):
        acc = np.zeros(size)
        for b in batches:
            for v in b.column(0):
                acc += np.frombuffer(v.as_py(), dtype="<f8")
        yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], names=["v"])

    total = np.zeros(size)
    for row in parts.select("v").repartition(mergers).mapInArrow(merge, "v binary").collect():
        total += np.frombuffer(bytes(row.v), dtype="<f8")
    return total


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as one struct ``row`` beside the given columns, so that names cannot clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(k) for k, c in columns.items()))
