"""Rings of masks, unions and repairs against plain Python on the same figures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from geolith.operators import boundaries as B
from geolith.session import Rounds


def area(points):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1])) / 2


def rings_of(found, x="x", y="y"):
    rows = {}
    for r in found.orderBy("place").collect():
        rows.setdefault(r["ring"], []).append((r[x], r[y]))
        assert r["place"] == len(rows[r["ring"]]) - 1
    return list(rows.values())


def masked(spark, cells, width):
    return B.mask_rings(spark.createDataFrame(sorted(cells), "i INT, j INT").repartition(3), width)


def polygons(spark, shapes):
    """shapes: (key, ring) rows."""
    return spark.createDataFrame([(k, [{"x": float(x), "y": float(y)} for x, y in ring]) for k, ring in shapes], "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")


def test_ring_of_one_long_snake(spark):
    """A spiral path of single cells whose one outline has over 100,000 sides."""
    side = 320
    cells = {(i, j) for i in range(0, side, 2) for j in range(side)} | {(i, (side - 1) if i % 4 == 1 else 0) for i in range(1, side - 1, 2)}
    e = B.mask_edges(spark.createDataFrame(sorted(cells), "i INT, j INT"), side)
    got = B.ranked(e.select("id", "next", "corner")).agg(F.count(F.lit(1)), F.countDistinct("ring"), F.countDistinct("place"), F.max("place"), F.max("n")).first()
    assert got[0] > 100_000 and got[1] == 1 and got[2] == got[0] == got[4] and got[3] == got[0] - 1


@pytest.mark.parametrize("seed", range(3))
def test_mask_rings(spark, seed):
    """Shoelace areas of the rings add up to the cells, and each corner turns."""
    rng = random.Random(seed)
    cells = {(i, j) for i in range(12) for j in range(15) if rng.random() < (0.3, 0.5, 0.8)[seed]}
    rings = rings_of(masked(spark, cells, 15), "j", "i")
    assert sum(area(r) for r in rings) == len(cells)
    for r in rings:
        assert r[0][::-1] == min(p[::-1] for p in r)
        assert all((a[0] == b[0]) != (a[1] == b[1]) and (a[0] == b[0]) != (b[0] == c[0]) for a, b, c in zip(r, r[1:] + r[:1], r[2:] + r[:2]))


def test_mask_rings_touching_in_a_corner_and_with_a_hole(spark):
    assert sorted(map(area, rings_of(masked(spark, {(0, 0), (1, 1)}, 2), "j", "i"))) == [1, 1]
    around = {(i, j) for i in range(3) for j in range(3)} - {(1, 1)}
    rows = masked(spark, around, 3).collect()
    assert {(r["hole"], sum(s["ring"] == r["ring"] for s in rows)) for r in rows} == {(False, 4), (True, 4)}
    assert masked(spark, {(0, 0)}, 1).filter("i IS NULL").count() == 0
    assert B.mask_rings(spark.createDataFrame([], "i INT, j INT"), 4).count() == 0


def inside(ring, x, y):
    odd = False
    for a, b in zip(ring, ring[1:] + ring[:1]):
        odd ^= (a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0]
    return odd


@pytest.mark.parametrize("seed", range(3))
def test_union_of_rectangles_and_l_shapes(spark, seed):
    rng = random.Random(seed)
    shapes = []
    for k in range(40):
        x, y, w, h = rng.randrange(30), rng.randrange(30), rng.randrange(2, 9), rng.randrange(2, 9)
        box = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        if k % 3 == 0:
            box[2:3] = [(x + w, y + 1), (x + 1, y + 1), (x + 1, y + h)]
            box.pop()
            box.append((x, y + h))
        shapes.append((k, box[:: -1 if k % 2 else 1]))
    shapes.append((1000, shapes[0][1]))  # one more time
    want = sum(any(inside(r, x + 0.5, y + 0.5) for _, r in shapes) for x in range(45) for y in range(45))
    rings = rings_of(B.union(polygons(spark, shapes), "k", "ring", 4.0))
    assert sum(map(area, rings)) == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("seed", range(3))
def test_union_of_turned_triangles(spark, seed):
    """Inclusion and exclusion of any two and three triangles, which lie in general position."""
    rng = random.Random(seed)
    shapes = [(k, [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(3)]) for k in range(3)]

    def clipped(subject, clip):
        clip = clip if area(clip) > 0 else clip[::-1]
        for a, b in zip(clip, clip[1:] + clip[:1]):
            side = lambda p, a=a, b=b: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
            out = []
            for p, q in zip(subject, subject[1:] + subject[:1]):
                if side(p) >= 0:
                    out.append(p)
                if side(p) * side(q) < 0:
                    t = side(p) / (side(p) - side(q))
                    out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            subject = out
        return subject

    want = 0.0
    for n in (1, 2, 3):
        for some in itertools.combinations([r for _, r in shapes], n):
            part = some[0]
            for other in some[1:]:
                part = clipped(part, other) if part else part
            want += (-1) ** (n + 1) * abs(area(part)) if part else 0.0
    rings = rings_of(B.union(polygons(spark, shapes), "k", "ring", 3.0))
    assert sum(map(area, rings)) == pytest.approx(want, abs=1e-3)


def test_repair_is_valid_and_idempotent(spark):
    broken = [
        (1, [(0, 0), (4, 4), (4, 0), (0, 4)]),  # a bow-tie
        (2, [(0, 0), (0, 0), (5, 0), (5, 5), (5, 5), (0, 5)]),  # doubled points
        (3, [(0, 0), (6, 0), (9, 0), (6, 0), (6, 6), (0, 6)]),  # a spike
        (4, [(0, 0), (6, 0), (6, 6), (0, 6), (0, 0), (6, 0), (6, 6), (0, 6)]),  # twice round
        (5, [(0, 10), (6, -8), (-9, 3), (9, 3), (-6, -8)]),  # a five-pointed star, whose middle is outside
        (6, [(0, 0), (1, 1)]),
        (7, [(2, 2), (2, 2), (2, 2)]),
    ]
    once = B.repaired(polygons(spark, broken), "k", "ring", 4.0).cache()
    rows = {}
    for r in once.orderBy("ring", "place").collect():
        rows.setdefault(r["k"], {}).setdefault(r["ring"], []).append((r["x"], r["y"]))
    got = {k: sorted(round(area(r), 3) for r in rings.values()) for k, rings in rows.items()}
    assert got[1] == [4, 4] and got[2] == [25] and got[3] == [36] and 4 not in got and 6 not in got and 7 not in got
    assert len(got[5]) == 5 and all(len(r) == 3 for r in rows[5].values())
    grid = [(x / 8 + 0.03, y / 8 + 0.03) for x in range(-80, 80) for y in range(-80, 90)]
    assert all(sum(inside(r, x, y) for r in rows[5].values()) == inside(broken[4][1], x, y) for x, y in grid[::7])
    again = B.repaired(B.ring_rows(once, "k").select("k", F.col("points").alias("ring")), "k", "ring", 4.0)
    key = lambda d: sorted((r["k"], r["place"], round(r["x"], 4), round(r["y"], 4), round(r["area"], 3)) for r in d.collect())
    assert key(again) == key(once)


def test_rings_like_rectangles_are_snapped(spark):
    turned = [(3.0, 0.0), (11.0, 6.0), (8.0, 10.0), (0.0, 4.0)]  # 10 by 5
    nicked = [*turned[:2], (9.0, 8.5), (8.0, 10.0), (0.0, 4.0)]
    triangle = [(0, 0), (4, 0), (0, 4)]
    d = polygons(spark, [(1, turned), (2, nicked), (3, triangle), (4, [(0, 0), (1, 1), (2, 2)]), (5, [(0, 0), (1, 0)])])
    got = {r["k"]: (r["snapped"], [(round(p["x"], 6), round(p["y"], 6)) for p in r["ring"]]) for r in B.snapped(d, "k", "ring", 0.8).collect()}
    assert got[1][0] and sorted(got[1][1]) == sorted(turned) and got[2][0] and abs(area(got[2][1])) == pytest.approx(50)
    assert got[3] == (False, triangle) and not got[4][0] and got[5] == (False, [(0, 0), (1, 0)])


def test_written_rounds_are_not_broadcast(spark):
    """A million equal rows are a file of next to nothing, but not in the driver's memory."""
    d = Rounds(spark, "equal").write(spark.range(0, 1_000_000, 1, 1).select((F.col("id") % 2).alias("id"), F.lit(7).cast("long").alias("v")))
    joined = d.select("id", "v").join(d.filter("v > 0").select(F.col("id").alias("o")), F.col("id") == F.col("o"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_snapping_stays_within_the_row(spark):
    d = polygons(spark, [(1, [(0, 0), (4, 0), (4, 4), (0, 4)]), (1, [(0, 0), (9, 0), (9, 2), (1, 2), (1, 9), (0, 9)]), (2, [(1, 1), (1, 1), (1, 1)])])
    found = B.snapped(d, "k", "ring", 0.75)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["k"], r["snapped"], len(r["ring"])) for r in found.collect()) == [(1, False, 6), (1, True, 4), (2, False, 3)]
