"""Boundaries as directed edges: rings of traced masks, unions of polygons and repaired rings.

A ring is never gathered. Each edge knows the edge that follows it; pointer doubling over these gives every edge
its ring and its place there in rounds that grow with the logarithm of the longest ring, each of one equality join. Polygons are cut where
edges meet, in grid cells, and of the pieces those stay that have covered ground on one side alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolith.functions import rings
from geolith.session import Rounds

#: Directions of edges on cells' sides, clockwise from the top one as rows go down: east, south, west, north.
EAST, SOUTH, WEST, NORTH = range(4)
#: A point this many units of `snap` from the line between its neighbours is no corner: what cuts and rounding leave.
STRAIGHT = 1.5
#: Tests beside a piece are made this many units of `snap` away from it.
BESIDE = 8.0


def ranked(edges: DataFrame) -> DataFrame:
    """(id, ring, place, corner_place, n, corners) of edges (id, next, corner) that form rings.

    ring is the smallest id of the ring, place counts from it along the ring, corner_place counts the corners before an edge, and n and corners are
    what the ring has of both. Edges whose chain ends, as next is null or not there, have no row. In each round an edge learns of twice as many edges after it: the
    least id among them and how far it is. When no edge learns of a smaller one, all know the least of their ring.
    """
    spark = edges.sparkSession
    rounds = Rounds(spark, "rings")
    one = F.when(F.col("corner"), 1).otherwise(0).cast("long")
    at = rounds.write(edges.select("id", "next", F.col("id").alias("ring"), F.lit(0).cast("long").alias("ahead"), F.lit(0).cast("long").alias("corners_ahead"), one.alias("held"), one.alias("own"), F.lit(True).alias("moved")))
    reach = 1
    while True:
        b = at.select(F.col("id").alias("b_id"), F.col("next").alias("b_next"), F.col("ring").alias("b_ring"), F.col("ahead").alias("b_ahead"), F.col("corners_ahead").alias("b_corners"), F.col("held").alias("b_held"))
        lower = F.col("b_ring") < F.col("ring")
        pick = lambda new, old: F.when(lower, new).otherwise(F.col(old))
        after = at.join(b, F.col("next") == F.col("b_id")).select(
            "id", F.col("b_next").alias("next"), pick(F.col("b_ring"), "ring").alias("ring"), pick(F.col("b_ahead") + reach, "ahead").alias("ahead"),
            pick(F.col("b_corners") + F.col("held"), "corners_ahead").alias("corners_ahead"), (F.col("held") + F.col("b_held")).alias("held"), "own", lower.alias("moved"),
        )
        at, reach = rounds.write(after), 2 * reach
        if at.filter("moved").isEmpty():
            break
    size = at.groupBy(F.col("ring").alias("r")).agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("corners"))
    back = lambda ahead, n: F.pmod(F.col(n) - F.col(ahead), F.greatest(F.col(n), F.lit(1)))
    return at.join(size, F.col("ring") == F.col("r")).select("id", "ring", back("ahead", "n").alias("place"), back("corners_ahead", "corners").alias("corner_place"), "n", "corners")


def mask_edges(mask: DataFrame, width: int) -> DataFrame:
    """(id, i, j, d, next, corner) of the sides of a mask's cells that border on none of it; (i, j) is the corner of a cell where the side starts.

    The mask lies to the right of each side, as rows go down. Where two cells meet in a corner alone, a side goes on around its own cell: regions
    are those of cells that share sides.
    """
    side = lambda a, b, di, dj, d: F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(di).alias("di"), F.lit(dj).alias("dj"), F.lit(d).alias("d"))
    sides = F.array(side(-1, 0, 0, 0, EAST), side(0, 1, 0, 1, SOUTH), side(1, 0, 1, 1, WEST), side(0, -1, 1, 0, NORTH))
    rows = mask.select("i", "j", F.explode(sides).alias("s")).select((F.col("i") + F.col("s.a")).alias("ni"), (F.col("j") + F.col("s.b")).alias("nj"), (F.col("i") + F.col("s.di")).alias("i"), (F.col("j") + F.col("s.dj")).alias("j"), "s.d")
    free = rows.join(mask.select(F.col("i").alias("ni"), F.col("j").alias("nj")), ["ni", "nj"], "left_anti")
    code = lambda i, j, d: (i.cast("long") * (width + 1) + j) * 4 + d
    i, j, d = F.col("i"), F.col("j"), F.col("d")
    end = lambda c, plus, minus: c + F.when(d == plus, 1).when(d == minus, -1).otherwise(0)
    e = free.select("i", "j", "d", code(i, j, d).alias("id"), end(i, SOUTH, NORTH).alias("ei"), end(j, EAST, WEST).alias("ej"))
    following = e.select(F.col("i").alias("ei"), F.col("j").alias("ej"), F.col("d").alias("nd"), F.col("id").alias("nid"))
    # at most two sides start in a corner of cells
    turn = F.pmod(F.col("nd") - d - 1, F.lit(4))
    chosen = e.join(following, ["ei", "ej"]).groupBy("id", "i", "j", "d").agg(F.min(F.struct(turn.alias("turn"), F.col("nid"), F.col("nd"))).alias("m"))
    turned = chosen.select(F.col("m.nid").alias("at"), (F.col("m.nd") != d).alias("corner"))
    return chosen.select("id", "i", "j", "d", F.col("m.nid").alias("next")).join(turned, F.col("id") == F.col("at")).drop("at")


def mask_rings(mask: DataFrame, width: int) -> DataFrame:
    """(ring, place, i, j, hole) of the corners of a mask's outlines, for cells (i, j) with columns from 0 to width - 1.

    ring is a number of its own, place counts the corners from 0 at the topmost, then leftmost one, clockwise around regions and counter-clockwise around holes, as rows go down.
    """
    e = mask_edges(mask, width)
    places = ranked(e.select("id", "next", "corner")).select("id", "ring", "corner_place")
    i, j, d = F.col("i"), F.col("j"), F.col("d")
    rows = e.filter("corner").join(places, "id")
    # twice the area by the corners' edges: a vertical side of length l at column j adds or takes j * l, so unit sides add up to the same
    area = e.join(places, "id").groupBy("ring").agg(F.sum(F.when(d == SOUTH, j).when(d == NORTH, -j).otherwise(0)).alias("area"))
    return rows.join(area, "ring").select("ring", F.col("corner_place").cast("int").alias("place"), i, j, (F.col("area") < 0).alias("hole"))


def edges_of(polygons: DataFrame, key: str, ring: str, snap: float, group: str | None = None) -> DataFrame:
    """(g, poly, ax, ay, bx, by) in units of `snap`: the edges of polygons' rings (arrays of points), a row for each ring; edges of no length go.

    g keeps what is not to meet apart: of polygons with different `group`, none knows the other.
    """
    unit = lambda v: F.round(v / snap).cast("long")
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    pairs = F.arrays_zip(F.col(ring).alias("a"), following.alias("b"))
    g = F.col(group) if group else F.lit(0)
    rows = polygons.filter(F.size(ring) > 2).select(g.alias("g"), F.col(key).alias("poly"), F.explode(pairs).alias("e"))
    rows = rows.select("g", "poly", *[unit(F.col(f"e.{end}.{axis}")).alias(f"{end}{axis}") for end in "ab" for axis in "xy"])
    return rows.filter("ax <> bx OR ay <> by")


def _split_by_cells(edges: DataFrame, cell: int) -> DataFrame:
    """Edges cut at the borders of the grid's cells, so that what meets an edge is bounded by a cell."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")

    def stops(a: Column, b: Column, d: Column) -> Column:
        first, last = F.floor(F.least(a, b) / cell) + 1, F.ceil(F.greatest(a, b) / cell) - 1
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda k: F.try_divide(k * cell - a, d))).otherwise(F.array().cast("array<double>"))

    at = F.array_sort(F.array_union(F.array(F.lit(0.0), F.lit(1.0)), F.concat(stops(F.col("ax"), F.col("bx"), dx), stops(F.col("ay"), F.col("by"), dy))))
    spot = lambda t: F.struct(F.round(F.col("ax") + t * dx).cast("long").alias("x"), F.round(F.col("ay") + t * dy).cast("long").alias("y"))
    cut = edges.select("g", "poly", F.transform(at, spot).alias("p")).select("g", "poly", F.explode(F.arrays_zip(F.col("p").alias("a"), F.slice("p", 2, F.size("p")).alias("b"))).alias("e"))
    return cut.select("g", "poly", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by")).filter("bx IS NOT NULL AND (ax <> bx OR ay <> by)")


def _undirected(edges: DataFrame) -> DataFrame:
    """Distinct (g, ax, ay, bx, by), from the lesser end."""
    a, b = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    rows = edges.select("g", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    return rows.select("g", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def _cells(x0: Column, y0: Column, x1: Column, y1: Column, cell: int) -> Column:
    span = lambda a, b: F.sequence(F.floor(a / cell), F.floor(b / cell))
    return F.flatten(F.transform(span(x0, x1), lambda i: F.transform(span(y0, y1), lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def pieces(edges: DataFrame, cell: int) -> DataFrame:
    """Distinct (g, ax, ay, bx, by) of the edges, cut wherever two of one group cross, touch or run along each other.

    Edges meet in grid cells; one that ends within a unit of another cuts it. Coordinates are whole units, so crossings are rounded to them.
    """
    least, most = lambda k: F.least(f"a{k}", f"b{k}"), lambda k: F.greatest(f"a{k}", f"b{k}")
    e = _undirected(_split_by_cells(edges, cell))
    at = e.withColumn("c", F.explode(_cells(least("x") - 1, least("y") - 1, most("x") + 1, most("y") + 1, cell))).select("*", "c.cx", "c.cy").drop("c")
    o = at.select("g", "cx", "cy", *[F.col(k).alias(f"o_{k}") for k in ("ax", "ay", "bx", "by")])
    ax, ay, bx, by, px, py, qx, qy = (F.col(k).cast("double") for k in ("ax", "ay", "bx", "by", "o_ax", "o_ay", "o_bx", "o_by"))
    rx, ry, sx, sy = bx - ax, by - ay, qx - px, qy - py
    d = rx * sy - ry * sx
    t, u = F.try_divide((px - ax) * sy - (py - ay) * sx, d), F.try_divide((px - ax) * ry - (py - ay) * rx, d)  # null for parallel ones
    # an edge is cut by each other one on its own; the crossing is computed from the lesser edge, so that both get the same point
    turned = F.struct("ax", "ay", "bx", "by") > F.struct("o_ax", "o_ay", "o_bx", "o_by")
    crossing = F.when(t.between(0, 1) & u.between(0, 1), F.struct(F.round(F.when(turned, px + u * sx).otherwise(ax + t * rx)).cast("long").alias("x"), F.round(F.when(turned, py + u * sy).otherwise(ay + t * ry)).cast("long").alias("y")))

    def touching(x: Column, y: Column, lx: str, ly: str) -> Column:
        length = F.sqrt(rx * rx + ry * ry)
        along = ((x - ax) * rx + (y - ay) * ry) / length
        off = F.abs((x - ax) * ry - (y - ay) * rx) / length
        return F.when((off <= 1) & along.between(0, length), F.struct(F.col(lx).alias("x"), F.col(ly).alias("y")))

    near = (F.col("o_ax") <= most("x") + 1) & (F.col("o_bx") >= least("x") - 1) & (F.least("o_ay", "o_by") <= most("y") + 1) & (F.greatest("o_ay", "o_by") >= least("y") - 1)
    other = F.struct("ax", "ay", "bx", "by") != F.struct("o_ax", "o_ay", "o_bx", "o_by")
    # edges that share several cells meet in the first of them
    first = (F.col("cx") == F.floor((F.greatest(least("x"), F.least("o_ax", "o_bx")) - 1) / cell)) & (F.col("cy") == F.floor((F.greatest(least("y"), F.least("o_ay", "o_by")) - 1) / cell))
    cuts = F.array(touching(px, py, "o_ax", "o_ay"), touching(qx, qy, "o_bx", "o_by"), crossing)
    met = at.join(o, ["g", "cx", "cy"]).filter(near & first & other).select("g", "ax", "ay", "bx", "by", F.explode(cuts).alias("cut")).filter("cut IS NOT NULL")
    ends = e.select("g", "ax", "ay", "bx", "by", F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))).alias("cut"))
    # what cuts an edge lies in its cell
    all_cuts = met.unionByName(ends).groupBy("g", "ax", "ay", "bx", "by").agg(F.collect_set("cut").alias("cuts"))
    way = lambda p: (p["x"] - F.col("ax")) * (F.col("bx") - F.col("ax")) + (p["y"] - F.col("ay")) * (F.col("by") - F.col("ay"))
    ordered = F.array_sort(F.array_distinct(F.transform("cuts", lambda p: F.struct(way(p).alias("w"), p["x"].alias("x"), p["y"].alias("y")))))
    cut = all_cuts.select("g", ordered.alias("p")).select("g", F.explode(F.arrays_zip(F.col("p").alias("a"), F.slice("p", 2, F.size("p")).alias("b"))).alias("e"))
    return _undirected(cut.select("g", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by")).filter("bx IS NOT NULL AND (ax <> bx OR ay <> by)"))


def covered(points: DataFrame, edges: DataFrame, cell: int) -> DataFrame:
    """Points (g, x, y, and others) that lie in a polygon of their group by the even-odd rule of all its edges.

    Points meet the boxes of polygons in grid cells, and of each such polygon the edges of the same band of rows.
    """
    box = edges.groupBy("g", "poly").agg(F.min(F.least("ax", "bx")).alias("x0"), F.max(F.greatest("ax", "bx")).alias("x1"), F.min(F.least("ay", "by")).alias("y0"), F.max(F.greatest("ay", "by")).alias("y1"))
    boxes = box.withColumn("c", F.explode(_cells(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), cell))).select("g", "poly", "x0", "x1", "y0", "y1", "c.cx", "c.cy")
    own = [c for c in points.columns if c not in ("x", "y")]
    placed = points.withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    near = placed.join(boxes, ["g", "cx", "cy"]).filter(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))).select(*own, "x", "y", "poly", F.col("cy").alias("band"))
    banded = edges.withColumn("band", F.explode(F.sequence(F.floor(F.least("ay", "by") / cell), F.floor(F.greatest("ay", "by") / cell))))
    bands = banded.select("g", "poly", "band", *[F.col(k).cast("double").alias(f"e_{k}") for k in ("ax", "ay", "bx", "by")])
    ax, ay, bx, by = (F.col(f"e_{k}") for k in ("ax", "ay", "bx", "by"))
    crossed = ((ay > F.col("y")) != (by > F.col("y"))) & (F.col("x") < F.try_divide((bx - ax) * (F.col("y") - ay), by - ay) + ax)
    hits = near.join(bands, ["g", "poly", "band"]).filter(crossed)
    return hits.groupBy(*own, "poly").agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 1").select(*own).distinct()


def outlined(edges: DataFrame, cell: int) -> DataFrame:
    """(g, ax, ay, bx, by): the boundary of what polygons cover, each piece with the covered side on its left.

    Pieces that have covered ground on both sides or on none go: what is inside another polygon, seams, spikes.
    """
    p = pieces(edges, cell)
    length = F.sqrt((F.col("bx") - F.col("ax")).cast("double") * (F.col("bx") - F.col("ax")) + (F.col("by") - F.col("ay")).cast("double") * (F.col("by") - F.col("ay")))
    nx, ny = -(F.col("by") - F.col("ay")) / length * BESIDE, (F.col("bx") - F.col("ax")) / length * BESIDE
    mx, my = (F.col("ax") + F.col("bx")) / 2.0, (F.col("ay") + F.col("by")) / 2.0
    sides = F.explode(F.array(*[F.struct(F.lit(left).alias("left"), (mx + nx * s).alias("x"), (my + ny * s).alias("y")) for left, s in ((True, 1), (False, -1))]))
    tested = covered(p.select("g", "ax", "ay", "bx", "by", sides.alias("s")).select("g", "ax", "ay", "bx", "by", "s.left", "s.x", "s.y"), edges, cell)
    one = tested.groupBy("g", "ax", "ay", "bx", "by").agg(F.count(F.lit(1)).alias("n"), F.max("left").alias("left")).filter("n = 1")
    end = lambda a, b: F.when(F.col("left"), F.col(a)).otherwise(F.col(b))
    return one.select("g", end("ax", "bx").alias("ax"), end("ay", "by").alias("ay"), end("bx", "ax").alias("bx"), end("by", "ay").alias("by"))


def _angle(x: Column, y: Column) -> Column:
    return F.atan2(y.cast("double"), x.cast("double"))


def stitched(boundary: DataFrame) -> DataFrame:
    """(g, ring, place, x, y, area) of the corners of rings, in order, from directed edges with the inside on their left.

    At a point where several rings touch, an edge goes on with the sharpest turn to the left, which keeps to its own face. area is the whole ring's, in square units:
    negative for a hole. ring is the first edge of the ring, from its leftmost, then lowest point.
    """
    id_ = F.struct("ax", "ay", "bx", "by", "g")
    e = boundary.select("*", id_.alias("id"), _angle(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")).alias("angle"))
    following = e.select("g", F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("id").alias("nid"), F.col("angle").alias("nangle"))
    turn = F.pmod(F.col("nangle") - F.col("angle") + F.lit(3.141592653589793), F.lit(6.283185307179586))  # pi: straight on, more: to the left
    # few edges start in one point
    chosen = e.join(following, ["g", "bx", "by"]).groupBy("id").agg(F.max(F.struct(turn.alias("turn"), F.col("nid"))).alias("m"))
    way = lambda edge, k: (F.col(f"{edge}.b{k}") - F.col(f"{edge}.a{k}")).cast("double")
    x1, y1, x2, y2 = way("id", "x"), way("id", "y"), way("m.nid", "x"), way("m.nid", "y")
    bend = F.coalesce(F.try_divide(F.abs(x1 * y2 - y1 * x2), F.hypot(x1 + x2, y1 + y2)) > STRAIGHT, F.lit(True)) | (x1 * x2 + y1 * y2 < 0)
    links = chosen.select("id", F.col("m.nid").alias("next"), bend.alias("bend"))
    corner = links.select(F.col("next").alias("id"), F.col("bend").alias("corner"))
    nodes = links.select("id", "next").join(corner, "id")
    at = ranked(nodes).join(nodes.select("id", "corner"), "id")
    cross = (F.col("id.ax").cast("double") * F.col("id.by") - F.col("id.bx").cast("double") * F.col("id.ay")) / 2
    area = at.groupBy(F.col("ring").alias("r")).agg(F.sum(cross).alias("area"))
    rows = at.filter("corner").join(area, F.col("ring") == F.col("r"))
    return rows.select(F.col("id.g").alias("g"), "ring", F.col("corner_place").cast("int").alias("place"), F.col("id.ax").alias("x"), F.col("id.ay").alias("y"), "area")


def union(polygons: DataFrame, key: str, ring: str, cell: float, snap: float = 1e-6, group: str | None = None) -> DataFrame:
    """(g, ring, place, x, y, area): corners of the outlines of all ground that the polygons (of one group) cover, counter-clockwise, and clockwise around holes.

    A polygon is the rows that share `key`, a ring each; by the even-odd rule of them, holes may be given as further rings and rings may cross
    themselves. Coordinates are rounded to `snap`, and ground narrower than about sixteen times that may be lost. `cell` is the side of the grid in which edges meet: near the length of
    usual edges. Rings of less than three points, null rings and such without an area have no rows; repeated polygons change nothing; an empty table gives no rows.
    """
    spark = polygons.sparkSession
    side = max(1, round(cell / snap))
    edges = Rounds(spark, "edges").write(edges_of(polygons, key, ring, snap, group))
    found = stitched(Rounds(spark, "outline").write(outlined(edges, side)))
    return found.select("g", "ring", "place", (F.col("x") * snap).alias("x"), (F.col("y") * snap).alias("y"), (F.col("area") * (snap * snap)).alias("area"))


def repaired(polygons: DataFrame, key: str, ring: str, cell: float, snap: float = 1e-6) -> DataFrame:
    """(key, ring, place, x, y, area): each polygon's ground by the even-odd rule as rings that do not cross; see union()."""
    return union(polygons, key, ring, cell, snap, group=key).withColumnRenamed("g", key)


def snapped(rows: DataFrame, key: str, ring: str, fill: float) -> DataFrame:
    """rows with `snapped`, whether their ring has at least the share `fill` of the smallest rectangle around it, and that rectangle in place of such a ring.

    A side of the smallest rectangle goes through two vertices: each pair's direction is tried, within the row, so that no ring meets others in a task. For rings of few vertices,
    such as simplified ones. Rings whose vertices are fewer than three, or all on one line, stay.
    """
    points = F.col(ring)

    def rectangle(u: Column) -> Column:
        turned = F.struct(F.transform(points, lambda p: p["x"] * u["x"] + p["y"] * u["y"]).alias("a"), F.transform(points, lambda p: p["y"] * u["x"] - p["x"] * u["y"]).alias("b"))
        spans = lambda t: F.struct(*[f(t[c]).alias(f"{c}{n}") for c in "ab" for n, f in enumerate((F.array_min, F.array_max))])
        sized = lambda m: F.struct(((m["a1"] - m["a0"]) * (m["b1"] - m["b0"])).alias("area"), u["x"].alias("ux"), u["y"].alias("uy"), *[m[c].alias(c) for c in ("a0", "a1", "b0", "b1")])
        return rings.bound(rings.bound(turned, spans), sized)

    def tried(p: Column, q: Column) -> Column:
        d = F.struct((q["x"] - p["x"]).alias("x"), (q["y"] - p["y"]).alias("y"), F.hypot(q["x"] - p["x"], q["y"] - p["y"]).alias("length"))
        return rings.bound(d, lambda d: F.when(d["length"] > 0, rings.bound(F.struct((d["x"] / d["length"]).alias("x"), (d["y"] / d["length"]).alias("y")), rectangle)))

    later = lambda i: F.slice(ring, i + 2, F.greatest(F.size(ring) - i - 1, F.lit(0)))
    best = F.array_min(F.transform(points, lambda p, i: F.array_min(F.transform(later(i), lambda q: tried(p, q)))))
    m = lambda c: F.col(f"_m.{c}")
    corner = lambda a, b: F.struct((m(a) * m("ux") - m(b) * m("uy")).alias("x"), (m(a) * m("uy") + m(b) * m("ux")).alias("y"))
    is_like = F.coalesce((m("area") > 0) & (F.abs(rings.signed_area(points)) >= fill * m("area") * (1 - 1e-9)), F.lit(False))
    found = rows.withColumn("_m", F.when(F.size(ring) > 2, best)).withColumn("snapped", is_like)
    return found.withColumn(ring, F.when(F.col("snapped"), F.array(corner("a0", "b0"), corner("a1", "b0"), corner("a1", "b1"), corner("a0", "b1"))).otherwise(points)).drop("_m")


def ring_rows(corners: DataFrame, *by: str) -> DataFrame:
    """(by, ring, points): the corners of each ring as one array, for rings of which each fits a row."""
    return corners.groupBy(*by, "ring").agg(F.array_sort(F.collect_list(F.struct("place", "x", "y"))).alias("p")).select(*by, "ring", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))
