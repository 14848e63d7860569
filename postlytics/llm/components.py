"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the smallest node of its neighbourhood."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("b"), F.col("m").alias("a")).where("a < b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, link to the smallest of them (a < b in e)."""
    low = e.groupBy("b").agg(F.min("a").alias("m"))
    j = e.join(low, "b")
    return (j.select(F.col("a").alias("b"), F.col("m").alias("a"))
            .union(low.select("b", F.col("m").alias("a")))
            .where("a < b").distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest node.

    Self loops and null ends are ignored, direction and repeated edges don't matter.  Each
    round joins edges with one row per node, so a hub is pre-aggregated and its join split by
    AQE; rounds are cut by checkpoint() in the shared folder.  An empty table gives no rows.
    Raises RuntimeError if `rounds` were not enough (logarithmic in the longest path).
    """
    e = (edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
         .where("a is not null and b is not null and a < b").distinct().checkpoint())
    state = None
    for _ in range(rounds):
        e = _small_star(_large_star(e)).checkpoint()
        seen = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = e.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
