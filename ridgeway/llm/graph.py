"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node of ``edges(u long, v long)``; root is the component's smallest node.

    Each round rewires neighbours to the smallest one they know; the forest
    is done when a round changes nothing. Minima are grouped with map-side
    combine and joined back, so a hub's neighbours are never in one task.
    Self loops are ignored: a node that has nothing else is not returned.
    State is checkpointed every round. Nulls in either column are dropped.
    """
    e = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        e = materialize(small.where("u <> v").distinct())
        mark = e.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"),
        ).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
