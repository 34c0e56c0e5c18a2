"""Connected components of an edge list, by alternating large and small stars.

Each round replaces edges by edges to the smallest known neighbour, using one grouped minimum
and one join; a hub with very many neighbours is a skewed join key, which adaptive execution splits.
Every round is written to the shared folder, so lost executors repeat at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gritstone.llm.store import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(around: DataFrame) -> DataFrame:
    """Link every neighbour b of a, and a itself, to the smallest of them."""
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    to_least = around.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without edges do not appear.

    ``edges`` has columns a and b of one orderable type, in any order and with repeats.
    Edges with a null end and loops are ignored. An empty input gives an empty result.
    """
    pairs = edges.where("a is not null and b is not null and a <> b")
    now = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        large = _both_ways(now)
        least = large.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = large.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        now = stored(_star(large), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = tuple(found)
