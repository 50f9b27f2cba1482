"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, saved


def _large(e: DataFrame) -> DataFrame:
    """Every neighbour greater than a node is tied to the least of the node and its neighbours."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a != b").distinct()


def _small(e: DataFrame) -> DataFrame:
    """Every node and its lesser neighbours are tied to the least of them. Edges have a < b."""
    least = e.groupBy("b").agg(F.min("a").alias("m"))
    tied = e.join(least, "b")
    return (
        tied.select(F.col("m").alias("x"), F.col("a").alias("y"))
        .unionByName(tied.select(F.col("m").alias("x"), F.col("b").alias("y")))
        .where("x != y")
        .distinct()
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the least node it reaches.

    Nulls and loops are ignored. Roots have a row as well. Each turn only moves edges; it ends
    when none of the nodes stands on both sides, so every edge leads to its root.
    """
    now = saved(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    while True:
        ends = now.select(F.col("a").alias("x"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
            now.select(F.col("b").alias("x"), F.lit(0).alias("a"), F.lit(1).alias("b"))
        )
        tied = ends.groupBy("x").agg(F.max("a").alias("a"), F.sum("b").alias("b"))
        if not tied.where("b > 1 or a + b > 1").agg(F.count("*").alias("n")).first().n:
            break
        after = saved(_small(_large(now)), "edges")
        drop(now)
        now = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
