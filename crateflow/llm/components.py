"""Connected components of a graph of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.session import cut_lineage


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each linked node is connected to.

    ``links`` has the columns a and b. Alternates hooking larger neighbours to the least one with hooking all of a node's smaller
    neighbours to the least of them, until all hang on one node that hangs on none: rounds grow with the logarithm of the longest chain. Group
    minima are aggregates with map-side combining; no neighbour list is collected.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        if _stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = large.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        least2 = tied.groupBy("a").agg(F.min("b").alias("m"))
        small = tied.join(least2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least2.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.distinct())
    else:
        raise RuntimeError("components haven't settled")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other only, which hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs")))
    per = ends.groupBy("node").agg(F.sum("hangs").alias("n"), F.min("hangs").alias("least"))
    return per.where("n > 1 or (n = 1 and least = 0)").isEmpty()
