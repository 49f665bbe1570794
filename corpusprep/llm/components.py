"""Connected components of an edge table, by alternating large and small stars.

Every round is a few joins and aggregations and is written to the shared folder, so the work of a round
is bounded by the number of edges and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: columns a, b (bigint). Returns ``node``, ``root`` (smallest node of its component) for every
    node that has an edge; an empty table for none."""
    links = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: the larger neighbours of each node move to its smallest one
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the smaller neighbours of each node, and the node itself, move to the smallest one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialize(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
