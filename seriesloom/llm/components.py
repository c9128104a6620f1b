"""Connected components of an edge table by alternating large and small stars; nothing but two numbers a round is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # A table, so that adaptive execution can split the join at a node with very many neighbours.
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "least")
    return both.join(least, both["u"] == least["c"]).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them. Edges run from u to a smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least.select(F.col("u").alias("c"), "m"), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; a component is named by its least node. edges: columns a, b."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, seen = written(edges, "edges"), None
    while True:
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == seen:
            break
        seen = tuple(sums)
        edges = written(_small(_large(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).distinct()
