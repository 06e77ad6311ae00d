"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import spread_join, stored


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link only, or none to a smaller node."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame, purpose: str = "components", rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``edges`` (columns a, b).

    Each step joins a node's links with the smallest of its neighbours. Links of a node with very
    many neighbours are spread over tasks, and only (node, smallest neighbour) pairs are aggregated,
    so no neighbourhood is ever gathered. Every step is a written table; the loop ends when each node
    is a root or has a root as its only link. Self links and repeated links are fine; nodes must not be null.
    """
    links = stored(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose
    )
    for _ in range(rounds):
        if _settled(links):
            break
        # Large star: a node's larger neighbours move to the smallest node among it and its neighbours.
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = spread_join(both, lowest, "a", F.col("b")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = spread_join(large, least, "a", F.col("b"))
        small = moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        links = stored(small.distinct(), purpose)
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
