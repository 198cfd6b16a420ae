"""Connected components of a graph of links, by alternating large and small stars; nothing goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchlytics.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.least("m", "u").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select("b", "m").union(least.select("a", "m")).toDF("a", "b").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of one type); root is the component's smallest node.

    Links to itself or with a null are left out; repeated and reversed ones count once. Every round is written to the
    shared folder, so a lost executor costs no earlier rounds. A star with many nodes is joined by a key that has one row
    on the other side, which Spark splits when it is skewed.
    """
    a, b = links.columns
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct())
    while True:
        # Done when every node has one link and no end of a link has one itself.
        tails = edges.groupBy("a").agg(F.count("*").alias("n"))
        heads = edges.select(F.col("b").alias("a")).distinct().withColumn("head", F.lit(True))
        if tails.join(heads, "a", "left").where("n > 1 OR head").isEmpty():
            break
        edges = stored(_small_star(_large_star(edges)))
    return edges.toDF("node", "root").union(edges.select("b", "b").distinct())
