"""Connected components with DataFrame joins.

Alternating large-star and small-star steps: each reconnects every node's
neighbours to the smallest one it knows, and the number of steps grows with
the logarithm of the longest chain. Only minima per node are aggregated
(partially before the shuffle), never a node's list of neighbours, so a node
with a third of all links stays cheap. Each round is written to the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over directed links (a, b); ``large``: neighbours above a node
    go to its minimum, else those below it and itself."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    side = edges.where("b > a" if large else "b < a").join(least, "a")
    moved = side.select(F.col("b").alias("x"), F.col("least").alias("y"))
    if not large:
        moved = moved.unionByName(least.select(F.col("a").alias("x"), F.col("least").alias("y")))
    return moved.where("x <> y").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, component) of all nodes with a link to another node; the
    component is the smallest node that can be reached. Null ends and links of
    a node to itself are ignored."""
    now = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").distinct()
    now = materialise(now, name)
    before = None
    while True:
        both = now.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(
            now.select(F.col("y").alias("a"), F.col("x").alias("b")))
        lifted = _star(both, large=True)
        down = lifted.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        now = materialise(_star(down, large=False), name)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("y").alias("node")).distinct()
    return now.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
