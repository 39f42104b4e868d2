"""Connected components of an edge table, and what dissolves along them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolith.session import Rounds


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) and m, the least v of each u."""
    return edges.join(edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")), F.col("u") == F.col("k")).select("u", "v", "m")


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of (u, v): the label is the smallest node of the component.

    Each round hangs a node's neighbours on the smallest of them, first those above it, then those below, until
    nothing changes: stars around the labels, after rounds that grow with the logarithm of a component's length.
    Each is written out in the session's shared folder.
    """
    rounds, nodes_at = Rounds(edges.sparkSession, "components"), Rounds(edges.sparkSession, "component-nodes")
    turned = lambda d: d.select(F.col("v").alias("u"), F.col("u").alias("v"))
    edges = nodes_at.write(edges.select("u", "v").distinct())
    at = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    mark = None
    while True:
        large = _with_least(at.union(turned(at))).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        hung = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        at = rounds.write(_with_least(large.distinct()).select(hung.alias("e")).select("e.u", "e.v").filter("u <> v").distinct())
        now = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select("u").union(edges.select("v")).distinct()
    return nodes.join(at.select(F.col("u").alias("node"), "v"), F.col("u") == F.col("node"), "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("label"))


def overlaps(boxes: DataFrame, key: str, cell: float) -> DataFrame:
    """(u, v), u < v, of boxes (key, x0, x1, y0, y1) that touch or overlap; each box stands in the cells that it covers."""
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))
    a = boxes.select(key, "x0", "x1", "y0", "y1").withColumn("cx", span("x0", "x1")).withColumn("cy", span("y0", "y1"))
    b = a.select(*[F.col(c).alias(c if c in ("cx", "cy") else f"o_{c}") for c in a.columns])
    meet = (F.col(key) < F.col(f"o_{key}")) & (F.col("x0") <= F.col("o_x1")) & (F.col("o_x0") <= F.col("x1")) & (F.col("y0") <= F.col("o_y1")) & (F.col("o_y0") <= F.col("y1"))
    return a.join(b, ["cx", "cy"]).filter(meet).select(F.col(key).alias("u"), F.col(f"o_{key}").alias("v")).distinct()


def dissolved(boxes: DataFrame, key: str, cell: float) -> DataFrame:
    """(label, n, x0, x1, y0, y1): boxes that overlap, directly or through others, as one; the label is their smallest key."""
    labels = connected(overlaps(boxes, key, cell)).withColumnRenamed("node", key)
    rows = boxes.join(labels, key, "left").withColumn("label", F.coalesce("label", key))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
