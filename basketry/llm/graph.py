"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b long); root is the smallest node reachable.

    Only counts reach the driver. Each round is written to the shared folder; the minima are
    written before they are joined, so that a hub's edges are split over several tasks.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # large star: every larger neighbour of u is tied to the smallest node around u
        large = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large)
        # small star: u's smaller neighbours, and u itself, are tied to the smallest of them
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        tied = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(tied.union(least.select("a", "m")).where("a <> b").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b")).distinct()
