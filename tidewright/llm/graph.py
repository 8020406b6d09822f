"""Connected components over edges that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import removed, stored


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each node's component, for all nodes of edges (a, b), as a stored table.

    Large-star and small-star rounds until nothing changes; each round is written to the shared folder, so
    a lost executor costs at most one round. Loops and repeated edges are allowed; null ends are ignored.
    """
    flat = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars = stored(flat, "edges")
    before = None
    while True:
        # large star: every neighbour above a node goes to the least of the node and its neighbours
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).union(stars.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lower neighbours go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        moved = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct()
        old, stars = stars, stored(moved, "edges")
        removed(old)
        # hashes and counts of all edges: equal sums mean that the round changed nothing
        now = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("x")).first()
        if before == now:
            found = stored(stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(stars.select("b", "b").distinct()), "components")
            removed(stars)
            return found
        before = now
