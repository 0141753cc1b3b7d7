"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigilframe.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is moved to the node's smallest neighbour, or to the node."""
    both = edges.union(edges.select(F.col("parent"), F.col("node"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("low").alias("parent")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are moved to the smallest of these."""
    least = edges.groupBy("node").agg(F.min("parent").alias("low"))
    moved = edges.join(least, "node").where("parent > low").select(F.col("parent").alias("node"), F.col("low").alias("parent"))
    return moved.union(least.select("node", F.col("low").alias("parent"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and parent, the smallest node of its component, for every linked node but that one.

    ``links`` has two columns of longs. Large and small stars alternate until each
    component is one star (no parent is a node, and no node has two parents), which takes
    a number of rounds in the order of the logarithm of its size; every round is written,
    so none depends on an executor.
    """
    a, b = links.columns
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("parent")).distinct()
    edges = settle(edges, "links")
    while True:
        edges = settle(_small_star(settle(_large_star(edges), "large-star")), "small-star")
        roots = edges.select(F.col("parent").alias("node"))
        several = edges.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        if edges.join(roots, "node", "left_semi").isEmpty() and several.isEmpty():
            return edges
