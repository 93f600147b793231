"""Connected components of a table of links by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import forget, saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link the smallest node it can reach.

    Large-star and small-star steps in turn: each replaces a node's links by links to the smallest node near
    it. Every step is a minimum per node (combined before the shuffle) and a join on the node, so a node with
    very many links costs no single task its whole list; the links of a hot node are split as any skewed join.
    The rounds grow with the logarithm of the longest path.
    """
    edges = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large-star: each larger neighbour v of u links to the smallest node near u
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: each smaller neighbour of u, and u itself, links to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = saved(small)
        # done when every node has one link and no link's end has a link of its own
        one = after.agg(F.count("*").alias("n")).first()["n"]
        nodes = after.select("u").distinct().count() if one else 0
        chained = one and after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        forget(edges)
        edges = after
        if one == nodes and not chained:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
