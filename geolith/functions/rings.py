"""Polygon rings as arrays of (x, y) structs, without a geometry library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def edges(ring: Column) -> Column:
    """(a, b) of each edge of an open ring, the last back to the first vertex."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once inside functions on arrays, which know no common parts."""
    return F.transform(F.array(value), use)[0]


def _sum(parts: Column, value) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, e: acc + value(e))


def _cross(e: Column) -> Column:
    return e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]


def signed_area(ring: Column) -> Column:
    return _sum(edges(ring), _cross) / 2.0


def perimeter(ring: Column) -> Column:
    return _sum(edges(ring), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))


def centroid(ring: Column) -> tuple[Column, Column]:
    """Of the area; null for an area of 0."""
    whole = signed_area(ring) * 6.0
    return tuple(F.try_divide(_sum(edges(ring), lambda e, k=k: (e["a"][k] + e["b"][k]) * _cross(e)), F.nullif(whole, F.lit(0.0))) for k in ("x", "y"))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule; a point level with a vertex counts its edge once."""
    crossed = F.filter(edges(ring), lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))
    return F.size(crossed) % 2 == 1


def lattice_points_inside(ring: Column, x0: float, y0: float, step: float, columns: int, rows: int) -> Column:
    """How many points (x0 + step * i, y0 + step * j), i < columns and j < rows, a ring contains; see contains().

    A row of points is not tested point by point: each edge that crosses it has so many points on its left, and these numbers, the largest first, are added and taken in turn.
    """

    def on_left(c: Column) -> Column:
        held = F.greatest(F.least(c, F.lit(x0 + step * columns)), F.lit(x0 - step))
        return bound(held, lambda v: bound(F.floor((v - x0) / step), lambda k: F.greatest(k + F.when(k * step + x0 < v, 1).otherwise(0), F.lit(0).cast("long"))))

    def in_row(held: Column, y: Column) -> Column:
        crossed = F.filter(held, lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y))
        at = F.transform(crossed, lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
        left = F.sort_array(F.transform(F.filter(at, lambda c: c.isNotNull()), on_left), asc=False)
        return F.aggregate(F.transform(left, lambda n, i: F.when(i % 2 == 0, n).otherwise(-n)), F.lit(0).cast("long"), lambda acc, n: acc + n)

    ys = F.array(*[F.lit(y0 + step * j) for j in range(rows)])
    return bound(edges(ring), lambda held: F.aggregate(ys, F.lit(0).cast("long"), lambda acc, y: acc + in_row(held, y)))


def valid(ring: Column) -> Column:
    """At least three different vertices and an area."""
    return (F.size(F.array_distinct(ring)) >= 3) & (F.abs(signed_area(ring)) > 0)


def local_frame(ring: Column, cx: Column, cy: Column) -> Column:
    return F.transform(ring, lambda p: F.struct((p["x"] - cx).alias("x"), (p["y"] - cy).alias("y")))


def longest_edge_bearing(ring: Column) -> Column:
    """Direction of the longest edge in degrees from the x axis, from 0 to 180; the first of equals."""
    scored = F.transform(edges(ring), lambda e, i: F.struct(F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]).alias("l"), (-i).alias("i"), F.atan2(e["b"]["y"] - e["a"]["y"], e["b"]["x"] - e["a"]["x"]).alias("d")))
    return F.pmod(F.degrees(F.array_max(scored)["d"]), F.lit(180.0))


def oriented_rectangle(cx: Column, cy: Column, heading: Column, length: Column, width: Column) -> Column:
    """Four corners of a rectangle along a heading (degrees clockwise from north)."""
    a = F.radians(heading)
    ux, uy = F.sin(a), F.cos(a)
    half_l, half_w = length / 2.0, width / 2.0
    return F.array(*[point(cx + ux * half_l * s + uy * half_w * t, cy + uy * half_l * s - ux * half_w * t) for s, t in ((1, 1), (1, -1), (-1, -1), (-1, 1))])


def distance_to_rectangle(x: Column, y: Column, cx: Column, cy: Column, heading: Column, length: Column, width: Column) -> Column:
    """The larger overhang along or across an oriented rectangle; negative inside."""
    a = F.radians(heading)
    along = (x - cx) * F.sin(a) + (y - cy) * F.cos(a)
    across = (x - cx) * F.cos(a) - (y - cy) * F.sin(a)
    return F.greatest(F.abs(along) - length / 2.0, F.abs(across) - width / 2.0)


def distance_to_segment(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.try_divide((x - ax) * dx + (y - ay) * dy, F.nullif(dx * dx + dy * dy, F.lit(0.0))), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.hypot(x - ax - t * dx, y - ay - t * dy)


def clipped_to_box(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The part of a ring inside a box, cut by one side of it after the other; several parts stay joined along the sides."""
    sides = F.array(*[F.struct(F.lit(axis).alias("axis"), bound.cast("double").alias("bound"), F.lit(sign).alias("sign")) for axis, bound, sign in (("x", x0, 1.0), ("x", x1, -1.0), ("y", y0, 1.0), ("y", y1, -1.0))])

    def cut(held: Column, side: Column) -> Column:
        beyond = lambda p: (F.when(side["axis"] == "x", p["x"]).otherwise(p["y"]) - side["bound"]) * side["sign"]

        def kept(e: Column) -> Column:
            p, q, here, there = e["a"], e["b"], beyond(e["a"]), beyond(e["b"])
            t = F.coalesce(F.try_divide(here, here - there), F.lit(0.0))
            at = point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"]))
            return F.filter(F.array(F.when(here >= 0, point(p["x"], p["y"])), F.when((here >= 0) != (there >= 0), at)), lambda v: v.isNotNull())

        return F.flatten(F.transform(edges(held), kept))

    return F.aggregate(sides, ring, cut)


def area_in_box(ring_edges: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area of what a ring, given by its edges, has in a box; rings may be concave, parts of any number.

    In each row of the box the ring has the sum, signed by direction, of how far its edges stand from the left side, at most the box's width; summed up
    edge by edge in closed form, so that no clipped ring is made.
    """
    width = x1 - x0
    inside = lambda x: F.least(F.greatest(x - x0, F.lit(0.0)), width)
    # the integral of `inside` up to x
    summed = lambda x: F.pow(inside(x), 2) / 2 + F.greatest(x - x1, F.lit(0.0)) * width

    def mean(xa: Column, xb: Column) -> Column:
        return F.when(F.abs(xb - xa) > 1e-9 * (1 + width), F.try_divide(summed(xb) - summed(xa), xb - xa)).otherwise(inside((xa + xb) / 2))

    def between(e: Column, low: Column, high: Column) -> Column:
        a, b = e["a"], e["b"]
        slope = F.coalesce(F.try_divide(b["x"] - a["x"], b["y"] - a["y"]), F.lit(0.0))
        ends = bound(slope, lambda s: F.struct((a["x"] + s * (low - a["y"])).alias("a"), (a["x"] + s * (high - a["y"])).alias("b")))
        return (high - low) * bound(ends, lambda x: mean(x["a"], x["b"]))

    def part(e: Column) -> Column:
        held = lambda y: F.least(F.greatest(y, y0), y1)
        return bound(F.struct(held(e["a"]["y"]).alias("low"), held(e["b"]["y"]).alias("high")), lambda h: F.when(h["low"] == h["high"], 0.0).otherwise(between(e, h["low"], h["high"])))

    return F.abs(_sum(ring_edges, part))


def clipped_length(ax: Column, ay: Column, bx: Column, by: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Length of a segment inside a box, by the parameters at which it passes the sides."""
    dx, dy = bx - ax, by - ay
    lows, highs = [F.lit(0.0)], [F.lit(1.0)]
    for d, a, lo, hi in ((dx, ax, x0, x1), (dy, ay, y0, y1)):
        p, q = F.try_divide(lo - a, F.nullif(d, F.lit(0.0))), F.try_divide(hi - a, F.nullif(d, F.lit(0.0)))
        outside = (d == 0) & ~a.between(lo, hi)
        lows.append(F.when(outside, 2.0).otherwise(F.coalesce(F.least(p, q), F.lit(0.0))))
        highs.append(F.coalesce(F.greatest(p, q), F.lit(1.0)))
    return F.greatest(F.least(*highs) - F.greatest(*lows), F.lit(0.0)) * F.hypot(dx, dy)
