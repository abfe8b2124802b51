"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candela.llm import text as tx


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest one (itself included)."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them. Edges run from a smaller a to a larger b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a != b")
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named after its smallest node.

    Nodes may be of any type that orders. Every round is written to the shared
    folder; counts and a sum of hashes tell the driver when nothing moves any more.
    An empty table has no nodes.
    """
    start = edges.where("a is not null and b is not null and a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    now, known = tx.write_table(start, "edges"), None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen.n, seen.h) == known or not seen.n:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
        known = (seen.n, seen.h)
        now = tx.write_table(_small_star(_large_star(now)), "edges")
