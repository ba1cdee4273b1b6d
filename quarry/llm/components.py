"""Connected components of a graph held in a DataFrame, by alternating large-star and small-star rounds.

Each round is two grouped minima with partial aggregation and two joins; edges are written between rounds, so the lineage
stays short and no edge or label comes to the driver. Hubs are no trouble: a hub's minimum is aggregated before the
shuffle, and the join that gives it to its neighbours is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """edges (a, b) of one orderable type -> (node, component), one row for each node with an edge to another;
    component is the least node reachable. Loops and repeated edges don't matter; nulls have no edges."""
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    mark = lambda df: tuple(df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
    was = mark(now)
    for _ in range(rounds):
        if not was[0]:
            break
        now = stage(small_star(large_star(now)), "cc")
        new = mark(now)
        if new == was:
            break
        was = new
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
