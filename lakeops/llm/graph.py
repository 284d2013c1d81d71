"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("b"), F.least("m", "u").alias("a"))
        .where("a < b").select("a", "b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them; edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    own = moved.select(F.col("m").alias("a"), "b")
    other = moved.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
    return own.union(other).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node is either a centre or tied to one centre alone."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("centre")).union(
        edges.select("a", F.lit(0), F.lit(1))
    )
    role = ends.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("centre").alias("centre"))
    return role.agg(F.max(F.col("tied") + F.col("centre"))).first()[0] in (None, 1)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of an edge table ``(a, b)`` of numbers.

    ``component`` is the smallest node reachable.  Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the longest chain, and a
    table of stars needs none.
    """
    normal = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    current = materialise(normal, name)
    while not _settled(current):
        current = materialise(_small_star(_large_star(current)), name)
    leaves = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.union(current.select("a", "a").distinct())
