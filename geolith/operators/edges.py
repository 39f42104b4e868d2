"""Edges, straight lines and shifts of rasters (i, j, z)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.operators.graph import connected
from geolith.operators.rasters import AROUND, shifted
from geolith.session import Rounds

#: A cell's own place and its eight neighbours, with the weights of the slope along columns and along rows.
SLOPES = {(a, b): ((2 - abs(a)) * b, (2 - abs(b)) * a) for a in (-1, 0, 1) for b in (-1, 0, 1)}
#: Neighbours ahead by the sector of the gradient's direction: along the row, down-right, along the column, down-left.
AHEAD = ((0, 1), (1, 1), (1, 0), (1, -1))
TAN = math.tan(math.pi / 8)


def slopes(raster: DataFrame) -> DataFrame:
    """(i, j, gx, gy) of cells with all eight neighbours: weighted differences across three columns and three rows."""
    offsets = tuple(SLOPES)
    moves = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(float(SLOPES[a, b][0])).alias("wx"), F.lit(float(SLOPES[a, b][1])).alias("wy")) for a, b in offsets]))
    rows = raster.withColumn("m", moves).select((F.col("i") - F.col("m.a")).alias("i"), (F.col("j") - F.col("m.b")).alias("j"), (F.col("z") * F.col("m.wx")).alias("x"), (F.col("z") * F.col("m.wy")).alias("y"))
    return rows.groupBy("i", "j").agg(F.round(F.sum("x"), 6).alias("gx"), F.round(F.sum("y"), 6).alias("gy"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(offsets)).drop("n")


def sector(gx: Column, gy: Column) -> Column:
    """Which of AHEAD the gradient points along, either way."""
    flat, steep = F.abs(gy) < F.abs(gx) * TAN, F.abs(gx) < F.abs(gy) * TAN
    return F.when(flat, 0).when(steep, 2).when((gx > 0) == (gy > 0), 1).otherwise(3)


def thinned(raster: DataFrame) -> DataFrame:
    """(i, j, size) of cells whose slope |gx| + |gy| is greatest along its own direction: above the cell behind, and not below that ahead.

    Each cell is sent to its neighbours and all meet in one aggregate.
    """
    g = slopes(raster).select("i", "j", (F.abs("gx") + F.abs("gy")).alias("size"), sector(F.col("gx"), F.col("gy")).alias("s"))
    moves = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 0), *AROUND)]))
    sent = g.withColumn("m", moves).select((F.col("i") - F.col("m.a")).alias("i"), (F.col("j") - F.col("m.b")).alias("j"), "m", "size", "s")
    at = lambda a, b, c: F.max(F.when((F.col("m.a") == a) & (F.col("m.b") == b), F.col(c)))
    around = {o: f"n{k}" for k, o in enumerate(AROUND)}
    met = sent.groupBy("i", "j").agg(at(0, 0, "size").alias("size"), at(0, 0, "s").alias("s"), *[F.coalesce(at(*o, "size"), F.lit(0.0)).alias(n) for o, n in around.items()])
    best = [(F.col("s") == k) & (F.col("size") > F.col(around[-a, -b])) & (F.col("size") >= F.col(around[a, b])) for k, (a, b) in enumerate(AHEAD)]
    return met.filter((F.col("size") > 0) & (best[0] | best[1] | best[2] | best[3])).select("i", "j", "size")


def edges(raster: DataFrame, low: float, high: float, width: int) -> DataFrame:
    """(i, j) of edge cells: thinned slopes above `low` that are linked, by sides or corners, to one above `high`. Columns go from 0 to width - 1.

    What is linked is one component of such cells, so that no front of cells is walked.
    """
    spark = raster.sparkSession
    weak = Rounds(spark, "thinned").write(thinned(raster).filter(F.col("size") > low).select("i", "j", (F.col("i") * width + F.col("j")).cast("long").alias("u"), (F.col("size") > high).alias("strong")))
    beside = shifted(weak.select("i", "j", "u"), ((0, 0), (0, 1), (1, 0), (1, 1), (1, -1))).withColumnRenamed("u", "v")
    labels = connected(weak.select("i", "j", "u").join(beside, ["i", "j"]).select("u", "v"))
    rows = weak.join(labels, F.col("u") == F.col("node"))
    kept = rows.groupBy("label").agg(F.max("strong").alias("any")).filter("any").select("label")
    return Rounds(spark, "edges").write(rows.join(kept, "label").select("i", "j"))


def _rho(k: Column, angles: int, i: Column, j: Column) -> Column:
    a = k * (math.pi / angles)
    return F.floor(j * F.cos(a) + i * F.sin(a) + 0.500001).cast("int")


def votes(cells: DataFrame, angles: int) -> DataFrame:
    """(k, rho, votes): how many cells lie on each line j cos(a) + i sin(a) = rho, rounded, for angles a = k pi / angles.

    A cell votes for each angle; votes are added up in tasks before they meet.
    """
    ballot = cells.select("i", "j", F.explode(F.sequence(F.lit(0), F.lit(angles - 1))).alias("k"))
    return ballot.select("k", _rho(F.col("k"), angles, F.col("i"), F.col("j")).alias("rho")).groupBy("k", "rho").agg(F.count(F.lit(1)).alias("votes"))


def lines(cells: DataFrame, angles: int, least: int) -> DataFrame:
    """(k, rho, votes) of lines with at least so many votes, none of whose eight neighbours in angle and distance has more, nor as many and comes first."""
    v = votes(cells, angles).filter(F.col("votes") >= least)
    moves = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in AROUND]))
    # past the last angle comes the first one, with the distance turned round
    k, rho = F.col("k") + F.col("m.a"), F.col("rho") + F.col("m.b")
    over = (k < 0) | (k >= angles)
    sent = v.withColumn("m", moves).select(F.pmod(k, F.lit(angles)).alias("k"), F.when(over, -rho).otherwise(rho).alias("rho"), F.struct("votes", (-F.col("k")).alias("a"), (-F.col("rho")).alias("b")).alias("other"))
    near = sent.groupBy("k", "rho").agg(F.max("other").alias("other"))
    own = F.struct("votes", (-F.col("k")).alias("a"), (-F.col("rho")).alias("b"))
    return v.join(near, ["k", "rho"], "left").filter(F.col("other").isNull() | (own > F.col("other"))).select("k", "rho", "votes")


def segments(cells: DataFrame, found: DataFrame, angles: int, gap: float, least: float) -> DataFrame:
    """(k, rho, start, stop, cells): runs of cells along each found line without a gap longer than `gap`, at least `least` long, by the place along the line."""
    # lines that stay are few beside the cells' votes
    on = cells.select("i", "j", F.explode(F.sequence(F.lit(0), F.lit(angles - 1))).alias("k")).withColumn("rho", _rho(F.col("k"), angles, F.col("i"), F.col("j"))).join(found.select("k", "rho"), ["k", "rho"])
    a = F.col("k") * (math.pi / angles)
    along = on.withColumn("t", F.round(F.col("i") * F.cos(a) - F.col("j") * F.sin(a), 6))
    w = Window.partitionBy("k", "rho").orderBy("t")
    opened = along.withColumn("fresh", F.when(F.col("t") - F.lag("t").over(w) > gap, 1).otherwise(0)).withColumn("run", F.sum("fresh").over(w))
    ends = opened.groupBy("k", "rho", "run").agg(F.min("t").alias("start"), F.max("t").alias("stop"), F.count(F.lit(1)).alias("cells"))
    return ends.filter(F.col("stop") - F.col("start") >= least).select("k", "rho", "start", "stop", "cells")


def phase_shift(left: DataFrame, right: DataFrame, height: int, width: int, block: int = 16, window: bool = True) -> DataFrame:
    """(di, dj, response): how far right, of the same height and width, is to be moved to match left, from the phases of their spectra.

    Rows are transformed in Arrow batches; a shuffle by blocks of columns turns the spectrum, whose columns are transformed, brought to unit size and
    transformed back; a second one by blocks of rows ends with the rows' way back. A task holds a row, or `block` columns or rows. Cells that are not
    there count as 0. With `window`, both fade out towards the borders, so that what is cut off there doesn't count.
    """
    both = left.select("i", "j", "z", F.lit(0).alias("side")).union(right.select("i", "j", "z", F.lit(1).alias("side"))).filter(F.col("i").between(0, height - 1) & F.col("j").between(0, width - 1) & F.col("z").isNotNull())
    rows = both.groupBy("i").agg(F.collect_list(F.struct("side", "j", F.col("z").cast("double").alias("z"))).alias("c"))
    half = width // 2 + 1
    fade = (lambda n: 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / max(n - 1, 1))) if window else np.ones
    blocks = -(-half // block)

    def rows_there(batches):
        for batch in batches:
            for i, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, z = cells.values, np.zeros((2, width))
                z[held.field("side").to_numpy(), held.field("j").to_numpy()] = held.field("z").to_numpy()
                f = np.fft.rfft(z * fade(width) * fade(height)[i], axis=1)
                padded = np.zeros((2, blocks * block), np.complex128)
                padded[:, :half] = f
                parts = np.ascontiguousarray(padded.reshape(2, blocks, block).transpose(1, 0, 2)).view(np.float64).reshape(blocks, -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks, dtype=np.int32)), pa.array(np.full(blocks, i, np.int32)), pa.array(list(parts), pa.list_(pa.float64()))], ["b", "i", "f"])

    def columns(table: pa.Table) -> pa.Table:
        f = np.zeros((height, 2, block), np.complex128)
        f[table.column("i").to_numpy()] = np.stack(table.column("f").to_numpy()).view(np.complex128).reshape(-1, 2, block)
        f = np.fft.fft(f, axis=0)
        cross = f[:, 0] * np.conj(f[:, 1])
        size = np.abs(cross)
        back = np.fft.ifft(np.where(size > 1e-12 * max(size.max(), 1e-300), cross / np.where(size > 0, size, 1), 0), axis=0)
        parts = [np.ascontiguousarray(back[at : at + block]).view(np.float64).ravel() for at in range(0, height, block)]
        return pa.table({"r": np.arange(len(parts), dtype=np.int32), "b": np.full(len(parts), table.column("b")[0].as_py(), np.int32), "f": pa.array(parts, pa.list_(pa.float64()))})

    def rows_back(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        n = min(block, height - r * block)
        f = np.zeros((n, blocks, block), np.complex128)
        for b, part in zip(table.column("b").to_pylist(), table.column("f").to_numpy(), strict=True):
            f[:, b] = part.view(np.complex128).reshape(n, block)
        z = np.fft.irfft(f.reshape(n, -1)[:, :half], n=width, axis=1)
        at = np.unravel_index(int(z.argmax()), z.shape)
        return pa.table({"i": pa.array([r * block + at[0]], pa.int32()), "j": pa.array([at[1]], pa.int32()), "v": [float(z[at])]})

    turned = rows.mapInArrow(rows_there, "b int, i int, f array<double>").groupBy("b").applyInArrow(columns, "r int, b int, f array<double>")
    peaks = turned.groupBy("r").applyInArrow(rows_back, "i int, j int, v double")
    best = peaks.agg(F.max(F.struct(F.round("v", 9).alias("v"), (-F.col("i")).alias("i"), (-F.col("j")).alias("j"))).alias("m")).filter("m IS NOT NULL")
    signed = lambda v, n: F.when(-v > n // 2, -v - n).otherwise(-v).cast("int")
    return best.select(signed(F.col("m.i"), height).alias("di"), signed(F.col("m.j"), width).alias("dj"), F.col("m.v").alias("response"))
