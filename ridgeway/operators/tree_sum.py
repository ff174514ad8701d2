"""Sums of packed vectors, one per task, in a tree: mergers add up shares as streams, then one task the rest."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

MERGERS = 32
PACKED = "part int, v binary"


def packed(vector) -> "pa.RecordBatch":  # noqa: F821
    """One task's vector as a row; ``part`` deals the tasks out to the mergers."""
    import pyarrow as pa
    from pyspark import TaskContext

    task = TaskContext.get()
    part = (task.partitionId() if task else 0) % MERGERS
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([np.ascontiguousarray(vector, "<f8").tobytes()], pa.binary())],
        names=["part", "v"],
    )


def _add(batches):
    import pyarrow as pa

    total = None
    for b in batches:
        for v in b.column("v"):
            x = np.frombuffer(v.as_py(), "<f8")
            total = x.copy() if total is None else total + x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "v"])


def merged(parts: DataFrame) -> DataFrame:
    """At most ``MERGERS`` rows whose sum is that of all tasks' rows; each merger holds one vector at a time."""
    return parts.repartition(MERGERS, "part").mapInArrow(_add, PACKED)


def tree_sum(parts: DataFrame) -> DataFrame:
    """One row (none for an empty input) with the sum of all tasks' rows."""
    return merged(parts).repartition(1).mapInArrow(_add, PACKED)


def collect_sum(parts: DataFrame, size: int, tasks: int | None = None) -> np.ndarray:
    """The sum on the driver, which receives at most ``MERGERS`` vectors; zeros for an empty input.

    ``tasks``: how many tasks give a vector, where known; no more than
    ``MERGERS`` need no mergers.
    """
    total = np.zeros(size)
    for r in (parts if tasks is not None and tasks <= MERGERS else merged(parts)).collect():
        total += np.frombuffer(bytes(r["v"]), "<f8")
    return total
