"""Connected components as joins: large-star and small-star rounds until nothing moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cleaned, stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, itself without one, or none."""
    above = edges.select(F.col("a").alias("node"), F.lit(1).alias("n"))
    below = edges.select(F.col("b").alias("node"), F.lit(0).alias("n"))
    nodes = above.union(below).groupBy("node").agg(F.sum("n").alias("up"), (F.min("n") == 0).alias("root"))
    with cleaned(edges.sparkSession):
        return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & F.col("root"))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")), "least")
    tied = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stored(tied.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours, and itself, to the smallest of them."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stored(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; a component is its smallest node.

    Pairs may be given in either order and more than once. A node with many
    neighbours is one row of a partial aggregate, stored, so that the join by it
    is between shuffles and adaptive execution can split it. Edges that are stars
    already cost no round.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    while not _are_stars(edges):
        edges = _small_star(_large_star(edges))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
