"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of the component of every node of the edges (a, b): columns node, root.

    Alternating star contraction: every node links what is larger around it to
    the smallest around it, then everything smaller to the smallest. The number
    of rounds grows with the logarithm of the longest path. Each round's links
    are stored, and minima combine on the map side, so a node with very many
    links sends one row per task.
    """
    links = T.staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        links = T.staged(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        # stars: no node has two centres, and no centre is itself a leaf
        leaves = links.groupBy("a").agg(F.count("*").alias("centres"))
        centres = links.select(F.col("b").alias("a")).distinct().join(leaves, "a", "left_semi").limit(1)
        if not leaves.where("centres > 1").limit(1).select("a").union(centres).count():
            break
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        down = links.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = T.staged(down.where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
