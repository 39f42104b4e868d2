"""Rasters as relations of (i, j, z): row, column, value. Neighbours are met by equality joins or windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.functions import rings

#: Cross element: the cell and its four neighbours.
CROSS = ((0, 0), (-1, 0), (1, 0), (0, -1), (0, 1))
AROUND = tuple((a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0))


def pooled(raster: DataFrame, size: int) -> DataFrame:
    """Mean of blocks of size x size cells."""
    return raster.groupBy(F.floor(F.col("i") / size).alias("i"), F.floor(F.col("j") / size).alias("j")).agg(F.avg("z").alias("z"))


def _slope_along(axis: str, across: str, step: float) -> Column:
    """Central difference; one-sided at the border."""
    w = Window.partitionBy(across).orderBy(axis)
    beside = lambda move, gap: F.when(F.abs(move(axis).over(w) - F.col(axis)) == gap, move("z").over(w))
    after, before = beside(F.lead, 1), beside(F.lag, 1)
    return F.coalesce((after - before) / (2 * step), (after - F.col("z")) / step, (F.col("z") - before) / step, F.lit(0.0))


def gradient(raster: DataFrame, step: float = 1.0) -> DataFrame:
    """Adds gx (along columns) and gy (along rows). Where a neighbour is missing, the slope is one-sided; without both it is 0."""
    return raster.withColumns({"gx": _slope_along("j", "i", step), "gy": _slope_along("i", "j", step)})


def slope_degrees(gx: Column, gy: Column) -> Column:
    return F.degrees(F.atan(F.sqrt(gx * gx + gy * gy)))


def aspect_degrees(gx: Column, gy: Column) -> Column:
    """Direction of descent, clockwise from north, for rows counted southwards."""
    return F.pmod(F.degrees(F.atan2(-gx, gy)), F.lit(360.0))


def hillshade(gx: Column, gy: Column, azimuth: float, altitude: float) -> Column:
    """Light from 0 to 1 on a surface, for rows counted southwards."""
    slope = F.atan(F.sqrt(gx * gx + gy * gy))
    aspect = F.atan2(gy, -gx)
    a, h = F.radians(F.lit(450.0 - azimuth)), F.radians(F.lit(altitude))
    return F.greatest(F.sin(h) * F.cos(slope) + F.cos(h) * F.sin(slope) * F.cos(a - aspect), F.lit(0.0))


def shifted(raster: DataFrame, offsets: tuple[tuple[int, int], ...]) -> DataFrame:
    """Each cell's row copied to the places that have it as a neighbour at one of the offsets."""
    moves = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in offsets]))
    rows = raster.withColumn("move", moves)
    return rows.select((F.col("i") - F.col("move.a")).alias("i"), (F.col("j") - F.col("move.b")).alias("j"), *[F.col(c) for c in raster.columns if c not in ("i", "j")])


def eroded(mask: DataFrame) -> DataFrame:
    """Cells (i, j) of the mask whose four neighbours are all in it; beyond the border is out."""
    return shifted(mask.select("i", "j"), CROSS).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(CROSS)).select("i", "j")


def dilated(mask: DataFrame) -> DataFrame:
    return shifted(mask.select("i", "j"), CROSS).distinct()


def opened(mask: DataFrame, height: int, width: int) -> DataFrame:
    """Erosion, then dilation, within height x width cells."""
    return dilated(eroded(mask)).filter(F.col("i").between(0, height - 1) & F.col("j").between(0, width - 1))


def labelled(mask: DataFrame, width: int) -> DataFrame:
    """(i, j, label): 4-connected components; the label is the smallest i * width + j in one."""
    from geolith.operators.graph import connected

    at = mask.select("i", "j", (F.col("i") * width + F.col("j")).cast("long").alias("u"))
    beside = shifted(at, ((0, 0), (0, 1), (1, 0))).withColumnRenamed("u", "v")
    labels = connected(at.join(beside, ["i", "j"]).select("u", "v"))
    return at.join(labels, F.col("u") == F.col("node")).select("i", "j", "label")


def bilinear(raster: DataFrame, samples: DataFrame, height: int, width: int) -> DataFrame:
    """Samples (y, x in cells) with z between their four cells; places beyond the border count as the border."""
    y, x = F.least(F.greatest(F.col("y"), F.lit(0.0)), F.lit(height - 1.0)), F.least(F.greatest(F.col("x"), F.lit(0.0)), F.lit(width - 1.0))
    fy, fx = y - F.floor(y), x - F.floor(x)
    corners = F.array(*[
        F.struct(F.least(F.floor(y) + a, F.lit(height - 1)).cast("long").alias("i"), F.least(F.floor(x) + b, F.lit(width - 1)).cast("long").alias("j"), ((fy if a else 1 - fy) * (fx if b else 1 - fx)).alias("w"))
        for a in (0, 1) for b in (0, 1)
    ])
    keys = samples.columns
    rows = samples.withColumn("c", F.explode(corners)).select(*keys, F.col("c.i").alias("i"), F.col("c.j").alias("j"), F.col("c.w").alias("w"))
    return rows.join(raster.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "z"), ["i", "j"]).groupBy(*keys).agg(F.sum(F.col("w") * F.col("z")).alias("z"))


def anti_transposed(raster: DataFrame, size: int) -> DataFrame:
    """Mirrored about the other diagonal; its own inverse."""
    return raster.select((F.lit(size - 1) - F.col("j")).alias("i"), (F.lit(size - 1) - F.col("i")).alias("j"), "z")


def painted_lines(lines: DataFrame, height: int, width: int, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """The columns of lines (ax, ay, bx, ey, w) with (i, j) of each cell of side 1 whose centre lies within w / 2 of the line.

    A line meets the cells of its own box alone.
    """
    half = F.col("w") / 2
    span = lambda a, b, start, n: F.sequence(F.greatest(F.floor(F.least(a, b) - half - start).cast("int"), F.lit(0)), F.least(F.floor(F.greatest(a, b) + half - start).cast("int"), F.lit(n - 1)))
    on = (F.greatest("ax", "bx") + half >= x0) & (F.least("ax", "bx") - half < x0 + width) & (F.greatest("ay", "ey") + half >= y0) & (F.least("ay", "ey") - half < y0 + height)
    cells = lines.filter(on).withColumn("j", F.explode(span("ax", "bx", x0, width))).withColumn("i", F.explode(span("ay", "ey", y0, height)))
    near = rings.distance_to_segment(F.col("j") + (0.5 + x0), F.col("i") + (0.5 + y0), F.col("ax"), F.col("ay"), F.col("bx"), F.col("ey")) <= half
    return cells.filter(near)


def painted_polygons(shapes: DataFrame, order: str, height: int, width: int) -> DataFrame:
    """(i, j, lit, top) of each cell with its centre in a polygon (outer, holes): whether the last one by `order` has it outside of its holes, and which that is.

    Each edge gives the place where it crosses the middle of each row that it spans; of a polygon and row, these in order bound spans of cells,
    by ring. Only such spans are written out as cells, and what lies over what is one aggregate.
    """
    ringed = shapes.select(F.col(order).alias("k"), F.posexplode(F.concat(F.array("outer"), "holes")).alias("ring", "points")).filter(F.size("points") > 2)
    e = ringed.select("k", "ring", F.explode(rings.edges(F.col("points"))).alias("e")).select("k", "ring", *[F.col(f"e.{end}.{axis}").alias(f"{end}{axis}") for end in "ab" for axis in "xy"])
    # rows whose middle is at or above the lower end and below the upper one
    first = F.greatest(F.ceil(F.least("ay", "by") - 0.5), F.lit(0)).cast("int")
    last = F.least(F.ceil(F.greatest("ay", "by") - 0.5) - 1, F.lit(height - 1)).cast("int")
    rows = e.filter(first <= last).withColumn("i", F.explode(F.sequence(first, last)))
    x = F.try_divide((F.col("bx") - F.col("ax")) * (F.col("i") + 0.5 - F.col("ay")), F.col("by") - F.col("ay")) + F.col("ax")
    crossed = rows.groupBy("k", "i").agg(F.array_sort(F.collect_list(F.struct("ring", x.alias("x")))).alias("c"))
    # a ring crosses a row an even number of times: crossings two by two bound its spans
    spans = crossed.withColumn("s", F.transform(F.sequence(F.lit(0), (F.size("c") / 2).cast("int") - 1), lambda n: F.struct(F.col("c")[2 * n]["ring"].alias("ring"), F.ceil(F.col("c")[2 * n]["x"] - 0.5).cast("int").alias("a"), (F.ceil(F.col("c")[2 * n + 1]["x"] - 0.5) - 1).cast("int").alias("b"))))
    parted = spans.select("k", "i", F.explode(F.filter("s", lambda s: s["ring"] == 0)).alias("o"), F.filter("s", lambda s: s["ring"] > 0).alias("h"))
    start, stop = F.greatest("o.a", F.lit(0)), F.least("o.b", F.lit(width - 1))
    cells = parted.filter(start <= stop).withColumn("j", F.explode(F.sequence(start, stop)))
    held = cells.select("i", "j", "k", (~F.exists("h", lambda h: F.col("j").between(h["a"], h["b"]))).alias("lit"))
    return held.groupBy("i", "j").agg(F.max(F.struct(F.col("k").alias("top"), "lit")).alias("m")).select("i", "j", "m.lit", "m.top")


def distances(mask: DataFrame, height: int, width: int) -> DataFrame:
    """(i, j, d2): squared distance of each of height x width cells to the nearest cell of the mask; none if it is empty.

    First the nearest mask cell of the same column, by windows; then each row's columns as parabolas, whose lower
    envelope gives the least over all columns in time linear in the row.
    """
    number = mask.sparkSession.range(height * width)
    cells = number.select(F.floor(F.col("id") / width).cast("int").alias("i"), (F.col("id") % width).cast("int").alias("j"))
    hit = cells.join(mask.select("i", "j", F.col("i").alias("at")), ["i", "j"], "left")
    column = Window.partitionBy("j").orderBy("i")
    above = F.last("at", ignorenulls=True).over(column)
    below = F.first("at", ignorenulls=True).over(column.rowsBetween(0, Window.unboundedFollowing))
    near = hit.withColumn("g", F.least(F.col("i") - above, below - F.col("i"))).filter("g IS NOT NULL").select("i", F.col("j").alias("k"), "g")

    def envelope(row: pd.DataFrame) -> pd.DataFrame:
        row = row.sort_values("k")
        k, f = row["k"].to_numpy(np.float64), row["g"].to_numpy(np.float64) ** 2
        owners, starts = [0], [-np.inf]  # parabolas of the envelope, and from where each is lowest
        for q in range(1, len(k)):
            meet = lambda p, q=q: ((f[q] + k[q] ** 2) - (f[p] + k[p] ** 2)) / (2 * (k[q] - k[p]))
            while (x := meet(owners[-1])) <= starts[-1]:
                owners.pop()
                starts.pop()
            owners.append(q)
            starts.append(x)
        j = np.arange(width)
        own = np.array(owners)[np.searchsorted(starts, j, side="right") - 1]
        return pd.DataFrame({"i": np.int32(row["i"].iloc[0]), "j": j.astype(np.int32), "d2": ((j - k[own]) ** 2 + f[own]).astype(np.int64)})

    return near.groupBy("i").applyInPandas(envelope, "i int, j int, d2 long")


def best_shift(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """(di, dj, score): the shift of right, up to `reach` cells, with the least mean difference to left; ties to the smallest."""
    offsets = tuple((a, b) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1))
    moves = F.explode(F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b in offsets]))
    moved = right.withColumn("m", moves).select((F.col("i") + F.col("m.di")).alias("i"), (F.col("j") + F.col("m.dj")).alias("j"), F.col("z").alias("other"), "m.di", "m.dj")
    scores = left.join(moved, ["i", "j"]).groupBy("di", "dj").agg(F.round(F.avg(F.abs(F.col("z") - F.col("other"))), 6).alias("score"))
    return scores.orderBy("score", "di", "dj").limit(1)


def outline(mask: DataFrame) -> DataFrame:
    """(i, j, a, b): each side, in direction (a, b), of a cell of the mask that borders on none of it."""
    sides = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in CROSS[1:]]))
    rows = mask.select("i", "j", sides.alias("s")).select("i", "j", "s.a", "s.b", (F.col("i") + F.col("s.a")).alias("ni"), (F.col("j") + F.col("s.b")).alias("nj"))
    beside = mask.select(F.col("i").alias("ni"), F.col("j").alias("nj"))
    return rows.join(beside, ["ni", "nj"], "left_anti").select("i", "j", "a", "b")
