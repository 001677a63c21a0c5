"""Connected components of a table of links, by alternating large-star and small-star steps (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm._shared import discard, joined_with_groups, written

MAX_ROUNDS = 60


def _pointed(links: DataFrame, total: int, *, itself: bool) -> tuple[DataFrame, DataFrame]:
    """links (u, v) with m, the least v of each u (or u itself if that is less and `itself`), and the table of u, m and n."""
    least = F.least(F.col("u"), F.min("v")) if itself else F.min("v")
    lowest = written(links.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n")), "lowest")
    return joined_with_groups(links, lowest, "u", "n", total).drop("n"), lowest


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of `links`; component is the smallest node reachable. Self-links are left out.

    Each round writes its links, so a lost executor costs one round at most. Rounds grow with the logarithm of the
    longest path. The least neighbour of a hub is an aggregate, combined before it is shuffled; it comes to the hub's links
    by a broadcast of the hubs, so they stay where they are (see joined_with_groups).
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    before, total = None, 2 * edges.count()
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pointed, lowest = _pointed(both, total, itself=True)
        large = written(pointed.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        discard(lowest, edges)
        pointed, lowest = _pointed(large, total, itself=False)
        small = pointed.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(lowest, large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, total = now, 2 * now[0]
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
