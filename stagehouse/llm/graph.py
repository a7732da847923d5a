"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.llm.storage import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) as (node, root): root is the smallest node reachable.  Every step is
    two shuffles of the edges, with minima combined before them; the number of steps grows with the
    logarithm of the longest path, and edges that are stars already take none.  An empty table gives
    an empty result."""
    edges = written(_tidy(edges.select("a", "b")), "edges")
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "edges")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root"), "root").distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    return (
        edges.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller neighbour, and is nobody's smaller one."""
    ends = edges.selectExpr("a AS node", "1 AS up", "0 AS down").union(
        edges.selectExpr("b", "0", "1")
    )
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 OR (up = 1 AND down > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return _tidy(
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _tidy(tied.union(least.select("a", F.col("least").alias("b"))))
