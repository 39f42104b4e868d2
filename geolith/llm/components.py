"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolith.llm.shared import Scratch


def components(edges: DataFrame, work: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is the smallest node of its component.

    Each round hangs a node's neighbours on the smallest of them and is written out; the number of rounds
    grows with the logarithm of a component's size. A node's smallest neighbour is aggregated in each task first and joined, so that
    a node of many neighbours is no one task's. Nodes without edges have no row; loops are left out.
    """
    least = lambda rows: rows.join(rows.groupBy("u").agg(F.min("v").alias("m")), "u")
    at = work.table(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    mark, step = None, 0
    while True:
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        low = least(large)
        # a node keeps its edge to the smallest, and what else it pointed to gets one too
        small = low.select("u", F.col("m").alias("v")).union(low.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        step += 1
        after = work.table(small.filter("u <> v").distinct(), f"{name}-{step}")
        now = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        work.drop(f"{name}-{step - 1}")
        if now == mark:
            roots = after.groupBy("v").agg(F.lit(1).alias("one")).select(F.col("v").alias("node"), F.col("v").alias("root"))
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        at, mark = after, now
