"""Connected components of an edge table, by alternating star contractions.

Every round is two joins of the edge table with its own per-vertex minima. The
minima are combined on the map side, and a vertex with very many neighbours is
one row on the small side of the join, so that adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (a, b: long); root is the least vertex.

    Self-loops and repeated edges are allowed; a vertex that only has a
    self-loop does not appear. An empty table gives an empty table. Null
    endpoints are ignored.
    """
    state = settled(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct())
    mark = None
    for _ in range(rounds):
        state = settled(_small_star(_large_star(state)))
        seen = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = seen
    raise RuntimeError(f"components did not settle in {rounds} rounds")
