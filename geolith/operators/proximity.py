"""Range joins through grid buckets: points near points, boxes over boxes, prioritised unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("long")


def cells_of_box(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """(cx, cy) of each grid cell that a box reaches into."""
    across = F.sequence(_cell(x0, size), _cell(x1, size))
    up = F.sequence(_cell(y0, size), _cell(y1, size))
    return F.flatten(F.transform(across, lambda i: F.transform(up, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def near_pairs(left: DataFrame, right: DataFrame, reach: float) -> DataFrame:
    """Rows of left (x, y) with rows of right (x, y, ...) at most `reach` away on either axis: a square, not a circle.

    The right side stands in its own cell of size `reach` and the left side in nine, so the join is an equality
    on the cell, which shuffles and splits like any other.
    """
    around = F.explode(F.array(*[F.struct((_cell(F.col("x"), reach) + i).alias("i"), (_cell(F.col("y"), reach) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    a = left.withColumn("bucket", around)
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], F.struct(_cell(F.col("x"), reach).alias("i"), _cell(F.col("y"), reach).alias("j")).alias("bucket"))
    near = (F.abs(F.col("x") - F.col("r_x")) <= reach) & (F.abs(F.col("y") - F.col("r_y")) <= reach)
    return a.join(b, "bucket").filter(near).drop("bucket")


def without_near(rows: DataFrame, kept: DataFrame, key: str, reach: float) -> DataFrame:
    """Rows with nothing of `kept` within the square."""
    return rows.join(near_pairs(rows, kept.select("x", "y"), reach).select(key).distinct(), key, "left_anti")


def prioritised_union(sources: list[DataFrame], key: str, reach: float) -> DataFrame:
    """All rows of the first source; of each later one what no kept row of an earlier source is near.

    Rows of one source do not push each other out.
    """
    return reduce(lambda kept, rows: kept.unionByName(without_near(rows, kept, key, reach)), sources)


def nearest_within(left: DataFrame, right: DataFrame, key: str, right_key: str, reach: float) -> DataFrame:
    """(key, right_key, distance): the nearest right row at most `reach` away, ties by right_key."""
    pairs = near_pairs(left, right, reach).withColumn("distance", F.hypot(F.col("x") - F.col("r_x"), F.col("y") - F.col("r_y"))).filter(F.col("distance") <= reach)
    best = pairs.groupBy(key).agg(F.min(F.struct("distance", f"r_{right_key}")).alias("best"))
    return best.select(key, F.col(f"best.r_{right_key}").alias(right_key), F.col("best.distance").alias("distance"))


def box_join(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """Points (x, y) with the boxes (x0, x1, y0, y1) that hold them, borders included.

    A box stands in every cell that it touches; choose `cell` near the size of a usual box.
    """
    span = lambda lo, hi: F.sequence(_cell(F.col(lo), cell), _cell(F.col(hi), cell))
    b = boxes.withColumn("bx", F.explode(span("x0", "x1"))).withColumn("by", F.explode(span("y0", "y1")))
    a = points.withColumns({"bx": _cell(F.col("x"), cell), "by": _cell(F.col("y"), cell)})
    return a.join(b, ["bx", "by"]).filter(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))).drop("bx", "by")


def box_totals(points: DataFrame, boxes: DataFrame, key: str, value: str, cell: float) -> DataFrame:
    """(key, n, total): how many points (x, y, value) each box (key, x0, x1, y0, y1) holds, borders included, and the sum of their values; boxes without points have no row.

    Pairs are never made, as they grow with the product of both sides. Points of one place become one row. In each grid column, those of the same y are a line; on
    each line that a box meets, its points are what has come up to the box's right end less what came before its left one: one running sum over points and ends.
    """
    v = F.col(value).cast("double")
    odd, nan = F.isnan(v) | (F.abs(v) == float("inf")), F.isnan(v)
    # infinite values and NaN, which no difference of sums could take away again, are counted
    sums = {"n": F.count(F.lit(1)), "held": F.count(v), "sum": F.coalesce(F.sum(F.when(~odd, v)), F.lit(0.0)), "most": F.count_if(nan | (v == float("inf"))), "least": F.count_if(nan | (v == float("-inf")))}
    x, y = F.col("x"), F.col("y")
    places = points.filter(x.isNotNull() & y.isNotNull()).groupBy(x.cast("double").alias("x"), y.cast("double").alias("y")).agg(*[c.alias(k) for k, c in sums.items()]).withColumn("bx", _cell(x, cell))
    lines = places.select("bx", "y", _cell(y, cell).alias("by")).distinct()
    span = lambda lo, hi: F.explode(F.sequence(_cell(F.col(lo), cell), _cell(F.col(hi), cell)))
    there = boxes.filter("x0 <= x1 AND y0 <= y1").select(key, "x0", "x1", "y0", "y1").withColumn("bx", span("x0", "x1")).withColumn("by", span("y0", "y1"))
    # merged: repeated boxes are a small file, but not in the driver's memory
    met = there.hint("merge").join(lines, ["bx", "by"]).filter(y.between(F.col("y0"), F.col("y1")))
    # the left end stands before the points of its x, the right one behind them
    end = lambda c, order, sign: F.struct(F.col(c).cast("double").alias("x"), F.lit(order).alias("order"), F.lit(sign).cast("long").alias("sign"))
    ends = met.select("bx", "y", key, F.explode(F.array(end("x0", 0, -1), end("x1", 2, 1))).alias("e")).select("bx", "y", "e.x", "e.order", "e.sign", key)
    stream = places.select("bx", "y", "x", F.lit(1).alias("order"), *sums).unionByName(ends, allowMissingColumns=True)
    so_far = Window.partitionBy("bx", "y").orderBy("x", "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = stream.select(key, "sign", *[F.sum(k).over(so_far).alias(k) for k in sums]).filter("sign IS NOT NULL")
    found = run.groupBy(key).agg(*[F.coalesce(F.sum(F.col("sign") * F.col(k)), F.lit(0)).alias(k) for k in sums]).filter("n > 0")
    most, least = F.col("most") > 0, F.col("least") > 0
    total = F.when(F.col("held") == 0, None).when(most & least, float("nan")).when(most, float("inf")).when(least, float("-inf")).otherwise(F.col("sum"))
    return found.select(key, "n", total.alias("total"))
