"""Connected components by alternating stars; no link, node or component leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def _lowest(links: DataFrame) -> DataFrame:
    """u and the lowest of its neighbours; written, so that Spark can split a node with very many links in the join."""
    return cut(links.groupBy("u").agg(F.min("v").alias("m")), "lowest")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (lowest node it is connected with) of every node of ``links`` (a, b), in rounds that grow with the
    logarithm of the number of nodes. Loops and repeated links don't matter; no links give no rows."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low_all = _lowest(both)
        large = both.join(low_all, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = cut(large.filter("u != v").distinct(), "large-star")
        low = _lowest(large)
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, cut(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "small-star")
        drop(before, low_all, large, low)
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
