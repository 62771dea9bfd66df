"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.staging import stage

#: Edges a task may have. A round over fewer than that needs no shuffle; one over more has a task for each so many.
EDGES = 50_000


def _least(edges: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours."""
    return edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the least node it is connected to.

    A round hangs every node's greater neighbours under its least neighbour, then its lesser ones;
    rounds go on until nothing moves. A node of many edges is an aggregate and a join key, never a
    list. Nulls and loops are left out.
    """
    edges = edges.select("a", "b").where("a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stage(edges, "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        tasks = now[0] // EDGES + 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct().coalesce(tasks), "stars").coalesce(tasks)
        least = _least(large)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").coalesce(tasks)
        edges, before = stage(small.distinct().coalesce(tasks), "edges").coalesce(tasks), now
