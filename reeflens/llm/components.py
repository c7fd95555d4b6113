"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = (down.join(least, "u").where("v > m")
             .select(F.col("v").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every edge ``(a, b)`` leads from a node with no other edge to one that has no way on."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("end")).select("end.*")
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``; component = its smallest node.

    The rows of a hub are never gathered: its smallest neighbour is a
    partial aggregate, and the join that deals it out can be split.  Both
    steps keep the number of edges in bounds and the loop ends after
    O(log^2 n) rounds, as soon as all that is left are stars.  Self-links and rows with a null end are ignored; an
    empty table gives an empty result.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    while not _stars(now):
        after = stored(_small_star(_large_star(now)), "edges")
        drop_stored(now)
        now = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("b").alias("component")))
