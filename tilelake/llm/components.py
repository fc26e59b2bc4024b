"""Connected components of an edge table by alternating large-star and small-star steps.

The published star-contraction scheme: every step is a grouped minimum and an equi-join, so a
node with a third of all edges shrinks in the partial aggregate and its join is split by AQE. Each
round is written to the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.session import materialize

MAX_ROUNDS = 60  # rounds grow with the logarithm of the longest path; running out raises


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge; the root is the smallest node of the component.

    Loops, repeated edges and edges with a null end add nothing. No edges: no rows.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    now = edges.where(F.col(a) != F.col(b)).select(hi.alias("hi"), lo.alias("lo")).distinct()
    now = materialize(now, "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        seen = tuple(state)
        now = materialize(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each smaller neighbour of a node, and the node, to its smallest neighbour."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
