"""Operators against brute force, invariants and hand-made cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from geolith.functions import geo, rings, shapes, tags
from geolith.operators import gates, proximity, ranking, rasters


def points(spark, rows):
    return spark.createDataFrame(rows, "k INT, x DOUBLE, y DOUBLE")


def test_near_is_a_square(spark):
    a = points(spark, [(1, 0.0, 0.0)])
    b = points(spark, [(k, *p) for k, p in enumerate([(7.9, 7.9), (8.0, 0.0), (8.1, 0.0), (-8.0, -8.0), (0.0, -8.01)])])
    assert sorted(r["r_k"] for r in proximity.near_pairs(a, b, 8.0).collect()) == [0, 1, 3]


def test_near_pairs_like_nested_loop(spark):
    rng = random.Random(1)
    a, b = ([(k, rng.uniform(-50, 50), rng.uniform(-50, 50)) for k in range(n)] for n in (150, 200))
    want = sorted((i, j) for i, x, y in a for j, u, v in b if abs(x - u) <= 6 and abs(y - v) <= 6)
    assert sorted((r["k"], r["r_k"]) for r in proximity.near_pairs(points(spark, a), points(spark, b), 6.0).collect()) == want


def test_prioritised_union_keeps_the_first_source_whole(spark):
    first, second = points(spark, [(1, 0.0, 0.0), (2, 1.0, 0.0)]), points(spark, [(3, 0.5, 0.5), (4, 20.0, 0.0), (5, 20.5, 0.0)])
    assert sorted(r["k"] for r in proximity.prioritised_union([first, second], "k", 2.0).collect()) == [1, 2, 4, 5]


def test_box_join(spark):
    rng = random.Random(2)
    pts = [(k, rng.uniform(0, 100), rng.uniform(0, 100)) for k in range(300)]
    boxes = [(k, x := rng.uniform(0, 90), x + rng.uniform(0, 30), y := rng.uniform(0, 90), y + rng.uniform(0, 5)) for k in range(40)]
    got = proximity.box_join(points(spark, pts), spark.createDataFrame(boxes, "b INT, x0 DOUBLE, x1 DOUBLE, y0 DOUBLE, y1 DOUBLE"), 10.0)
    assert sorted((r["k"], r["b"]) for r in got.collect()) == sorted((k, b) for k, x, y in pts for b, x0, x1, y0, y1 in boxes if x0 <= x <= x1 and y0 <= y <= y1)


def grid(spark, values):
    return spark.createDataFrame([(i, j, float(v)) for i, row in enumerate(values) for j, v in enumerate(row)], "i INT, j INT, z DOUBLE")


def array(df, shape, column="z"):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["i"], r["j"]] = r[column]
    return out


def test_gradient_is_numpys(spark):
    z = np.random.default_rng(3).normal(size=(7, 9))
    gy, gx = np.gradient(z)
    got = rasters.gradient(grid(spark, z))
    assert np.allclose(array(got, z.shape, "gx"), gx) and np.allclose(array(got, z.shape, "gy"), gy)


def test_pooling_keeps_the_mean_and_mirror_is_its_inverse(spark):
    z = np.random.default_rng(4).normal(size=(9, 9))
    assert math.isclose(array(rasters.pooled(grid(spark, z), 3), (3, 3)).mean(), z.mean())
    once = rasters.anti_transposed(grid(spark, z), 9)
    assert np.allclose(array(once, z.shape), z.T[::-1, ::-1]) and np.allclose(array(rasters.anti_transposed(once, 9), z.shape), z)


def test_opening_and_components(spark):
    m = np.random.default_rng(5).random((12, 14)) > 0.35
    e = np.pad(m, 1)
    e = e[1:-1, 1:-1] & e[:-2, 1:-1] & e[2:, 1:-1] & e[1:-1, :-2] & e[1:-1, 2:]
    d = np.pad(e, 1)
    want = d[1:-1, 1:-1] | d[:-2, 1:-1] | d[2:, 1:-1] | d[1:-1, :-2] | d[1:-1, 2:]
    mask = grid(spark, m).filter("z = 1")
    assert sorted((r["i"], r["j"]) for r in rasters.opened(mask, 12, 14).collect()) == sorted(zip(*map(list, np.nonzero(want))))
    label = {(i, j): i * 14 + j for i, j in zip(*np.nonzero(m))}
    changed = True
    while changed:
        changed = False
        for (i, j), v in label.items():
            low = min(label.get((i + a, j + b), v) for a, b in rasters.CROSS)
            if low < v:
                label[i, j], changed = low, True
    assert {(r["i"], r["j"]): r["label"] for r in rasters.labelled(mask, 14).collect()} == label


def test_long_chains_are_one_component(spark):
    from geolith.operators.graph import connected, dissolved

    chain = [0, *range(300, 0, -1)]
    got = connected(spark.createDataFrame([*zip(chain, chain[1:]), (400, 400)], "u BIGINT, v BIGINT")).collect()
    assert {r["node"]: r["label"] for r in got} == {**dict.fromkeys(range(301), 0), 400: 400} and len(got) == 302
    street = spark.createDataFrame([(v, float(k), k + 1.1, 0.0, 1.0) for k, v in enumerate(chain)], "id BIGINT, x0 DOUBLE, x1 DOUBLE, y0 DOUBLE, y1 DOUBLE")
    assert [tuple(r) for r in dissolved(street, "id", 1.5).collect()] == [(0, 301, 0.0, 301.1, 0.0, 1.0)]
    z = np.zeros((5, 151))  # a hairpin, upside down
    z[0], z[2], z[4], z[1, 150], z[3, 0] = 1, 1, 1, 1, 1
    cells = rasters.labelled(grid(spark, z).filter("z = 1"), 151).collect()
    assert len(cells) == 455 and {r["label"] for r in cells} == {0}


def test_distances(spark):
    m = np.random.default_rng(6).random((8, 10)) > 0.9
    cells = list(zip(*np.nonzero(m)))
    got = rasters.distances(grid(spark, m).filter("z = 1"), 8, 10)
    assert all(r["d2"] == min((r["i"] - a) ** 2 + (r["j"] - b) ** 2 for a, b in cells) for r in got.collect()) and got.count() == 80
    assert rasters.distances(grid(spark, m).filter("false"), 8, 10).count() == 0


def test_bilinear_at_cells_and_beyond(spark):
    z = np.arange(12.0).reshape(3, 4)
    s = spark.createDataFrame([(1.0, 2.0), (0.5, 0.5), (-3.0, 9.0)], "y DOUBLE, x DOUBLE")
    assert {(r["y"], r["x"]): r["z"] for r in rasters.bilinear(grid(spark, z), s, 3, 4).collect()} == {(1.0, 2.0): 6.0, (0.5, 0.5): 2.5, (-3.0, 9.0): 3.0}


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def ring_of(values):
    return F.array(*[rings.point(F.lit(float(x)), F.lit(float(y))) for x, y in values])


def test_rings(spark):
    r = ring_of([(0, 0), (4, 0), (4, 3), (0, 3)])
    cx, cy = rings.centroid(r)
    got = one(spark, a=rings.signed_area(r), p=rings.perimeter(r), x=cx, y=cy, within=rings.contains(r, F.lit(1.0), F.lit(1.0)), out=rings.contains(r, F.lit(5.0), F.lit(1.0)), b=rings.longest_edge_bearing(r), v=rings.valid(r))
    assert tuple(got) == (12.0, 14.0, 2.0, 1.5, True, False, 0.0, True)
    flat = ring_of([(0, 0), (1, 1), (2, 2)])
    assert tuple(one(spark, v=rings.valid(flat), x=rings.centroid(flat)[0])) == (False, None)


def test_rectangles(spark):
    box = rings.oriented_rectangle(F.lit(10.0), F.lit(20.0), F.lit(90.0), F.lit(8.0), F.lit(2.0))
    got = [(round(p["x"], 9), round(p["y"], 9)) for p in one(spark, r=box)["r"]]
    assert sorted(got) == [(6.0, 19.0), (6.0, 21.0), (14.0, 19.0), (14.0, 21.0)]
    d = lambda x, y: rings.distance_to_rectangle(F.lit(x), F.lit(y), F.lit(10.0), F.lit(20.0), F.lit(90.0), F.lit(8.0), F.lit(2.0))
    assert [round(v, 9) for v in one(spark, a=d(10.0, 20.0), b=d(16.0, 20.0), c=d(10.0, 24.0))] == [-1.0, 2.0, 3.0]


def test_least_rectangle_is_turned_with_the_ring(spark):
    for heading in (0.0, 17.0, 123.0):
        r = rings.oriented_rectangle(F.lit(0.0), F.lit(0.0), F.lit(heading), F.lit(9.0), F.lit(2.0))
        got = one(spark, b=shapes.bounding_rectangle(r))["b"]
        assert math.isclose(got["area"], 18, rel_tol=1e-9) and math.isclose(got["length"], 9, rel_tol=1e-9)
        assert math.isclose((90 - heading) % 180, got["bearing"] % 180, abs_tol=1e-6)
    assert shapes.least_rectangle(np.array([[1.0, 1.0]])) == (0.0, 0.0, 0.0)


def test_simplify():
    line = np.array([[0, 0], [1, 0.01], [2, 0], [2, 2], [0, 2], [0, 0]], float)
    assert shapes.simplified(line, 0.1).tolist() == [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]


def test_noise_does_not_depend_on_partitions(spark):
    cells = spark.range(400).select(F.col("id") % 20, F.floor(F.col("id") / 20)).toDF("i", "j")
    a, b = (sorted(map(tuple, cells.repartition(n).select("i", "j", shapes.noise(F.col("i"), F.col("j"), 5, 7).alias("v")).collect())) for n in (1, 7))
    assert a == b and all(0 <= v <= 1 for *_, v in a) and len({v for *_, v in a}) > 200


def test_projection_on_the_meridian_and_grid(spark):
    e, n = geo.utm_forward(F.lit(21.0), F.lit(42.0), 34)
    got = one(spark, e=e, n=n)
    assert math.isclose(got["e"], 500000, abs_tol=1e-6) and abs(got["n"] - 4649776.22) < 0.01
    c, r = geo.GridSpec(100.0, 0.0, 10.0, 3, 3).cell_of(F.lit(100.0), F.lit(-0.5))
    assert tuple(one(spark, c=c, r=r)) == (None, None)  # outside on one axis is outside


def test_tags(spark):
    rows = spark.createDataFrame([("12 m",), ("12,5",), ("",), (None,), ("tall",), ("7m high",)], "t STRING")
    assert [r[0] for r in rows.select(tags.number(F.col("t"))).collect()] == [12.0, 12.5, None, None, None, 7.0]
    got = one(spark, a=tags.degrees_minutes(F.lit(-3.0625), 2, "N", "S"), f=tags.feet(F.lit(100.0)), t=tags.trimmed_decimal(F.lit(118.5)), u=tags.trimmed_decimal(F.lit(120.0)), c=tags.cell_code(F.lit(3), F.lit(11)), n=tags.ascii_field(F.lit("Šar"), 5))
    assert tuple(got) == ("0303.750S", 328, "118.5", "120", "0311", "ar___")


def test_runs_and_offsets(spark):
    d = spark.createDataFrame([("a", k) for k in (1, 2, 4, 9, 10, 11, 13, 20)] + [("b", 5)], "g STRING, p BIGINT")
    assert {r["g"]: (r["start"], r["finish"]) for r in ranking.longest_run(d, "g", "p").collect()} == {"a": (9, 13), "b": (5, 5)}
    assert [r["o"] for r in d.withColumn("o", ranking.exclusive_sum("p", "g", "p")).filter("g = 'a'").orderBy("p").collect()] == [0, 1, 3, 7, 16, 26, 37, 50]


def test_gates(spark):
    d = spark.range(5)
    got = gates.summary([gates.gate(d, "few", F.count(F.lit(1)) < 9, F.count(F.lit(1))), gates.gate(d, "none", F.max("id") < 2, F.max("id"))])
    assert sorted(map(tuple, got.collect())) == [("few", "PASS", "5"), ("none", "FAIL", "4")]
    sides = gates.missing_and_extra(d.filter("id < 4"), d.filter("id > 0"), ["id"])
    assert sorted(map(tuple, sides.collect())) == [(0, "missing"), (4, "extra")]


@pytest.mark.parametrize("reach", [1])
def test_best_shift(spark, reach):
    z = np.random.default_rng(7).normal(size=(9, 9))
    moved = grid(spark, z).select((F.col("i") + 1).alias("i"), "j", "z")
    assert tuple(rasters.best_shift(grid(spark, z), moved, reach).first()) == (-1, 0, 0.0)


def test_connected(spark):
    from geolith.operators.graph import connected

    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 130)] + [(201, 200)]
    got = {r["node"]: r["label"] for r in connected(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert connected(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0


def test_percentiles_and_numbers_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 3, 900), np.round(rng.exponential(5, 900), 1))] + [(9, 2.5), (None, 1.0)]
    d = spark.createDataFrame(rows, "k INT, v DOUBLE")
    got = {r["k"]: r["p"] for r in ranking.percentiles(d.filter("k IS NOT NULL"), "k", "v", [0.0, 0.3, 0.5, 1.0], 0.7).collect()}
    for k in (0, 1, 2, 9):
        assert got[k] == pytest.approx(np.percentile([v for a, v in rows if a == k], [0, 30, 50, 100]).tolist())
    numbered = ranking.numbered(d.withColumn("id", F.monotonically_increasing_id()), ["k"], F.floor(F.col("v") / 2), ["v", "id"], "place").collect()
    for k in (0, 9, None):
        own = sorted((r for r in numbered if r["k"] == k), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(1, len(own) + 1)) and [(r["v"], r["id"]) for r in own] == sorted((r["v"], r["id"]) for r in own)


def test_distances_and_gaps(spark):
    rng = np.random.default_rng(5)
    cells = {(int(i), int(j)) for i, j in rng.integers(0, 25, (12, 2))}
    got = {(r["i"], r["j"]): r["d2"] for r in rasters.distances(spark.createDataFrame(sorted(cells), "i INT, j INT"), 25, 25).collect()}
    assert got == {(i, j): min((i - a) ** 2 + (j - b) ** 2 for a, b in cells) for i in range(25) for j in range(25)}
    row = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (0, 5, 50.0), (0, 6, 51.0), (0, 9, 7.0)], "i INT, j INT, z DOUBLE")
    assert {r["j"]: r["gx"] for r in rasters.gradient(row).collect()} == {0: 2.0, 1: 2.0, 5: 1.0, 6: 1.0, 9: 0.0}


def test_clipping_keeps_the_area_inside(spark):
    rng = np.random.default_rng(6)
    rings_of = [[(float(x), float(y)) for x, y in zip(*[r * f(a) + c for f, c in ((np.cos, rng.uniform(-2, 12)), (np.sin, rng.uniform(-2, 12)))])] for r in rng.uniform(1, 8, 20) for a in [np.linspace(0, 2 * np.pi, 9)[:-1]]]
    d = spark.createDataFrame([(k, r) for k, r in enumerate(rings_of)], "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    box = [F.lit(v) for v in (0.0, 0.0, 10.0, 10.0)]
    got = {r["k"]: r["area"] for r in d.select("k", F.abs(rings.signed_area(rings.clipped_to_box(F.col("ring"), *box))).alias("area")).collect()}
    g = (np.arange(400) + 0.5) / 40
    x, y = np.meshgrid(g, g)
    for k, ring in enumerate(rings_of):  # convex: inside where all edges have the cell on their left
        inside = np.ones_like(x, bool)
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            inside &= (bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0
        assert abs(got[k] - inside.mean() * 100) < 0.8
    summed = {r["k"]: r["area"] for r in d.select("k", rings.area_in_box(rings.edges(F.col("ring")), *box).alias("area")).collect()}
    assert summed == pytest.approx(got, abs=1e-9)


def test_area_in_a_box_of_concave_rings(spark):
    """A comb whose teeth alone reach into the box, either way round, and a box inside and outside of it."""
    comb = [(0, 0), (9, 0), (9, 10), (8, 10), (8, 1), (5, 1), (5, 10), (4, 10), (4, 1), (1, 1), (1, 10), (0, 10)]
    d = spark.createDataFrame([(k, [{"x": float(x), "y": float(y)} for x, y in r]) for k, r in ((0, comb), (1, comb[::-1]))], "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    areas = lambda *box: {r[0] for r in d.select(rings.area_in_box(rings.edges(F.col("ring")), *[F.lit(float(v)) for v in box]).alias("a")).collect()}
    assert areas(0, 5, 9, 8) == {9.0} and areas(0.5, 5, 4.5, 7) == {2.0} and areas(2, 3, 3, 4) == {0.0} and areas(2, 0, 4, 0.5) == {1.0} and areas(-5, -5, 20, 20) == {9.0 + 27.0}


def test_painted_polygons_as_point_by_point(spark):
    """Concave outlines and two holes, one of which reaches out of the polygon, against the even-odd rule of each cell."""
    rng = np.random.default_rng(8)
    shapes = []
    for k in range(12):
        c = rng.uniform(0, 30, 2)
        around = lambda r, n, c=c: [(float(c[0] + s * np.cos(a)), float(c[1] + s * np.sin(a))) for a, s in zip(np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(r / 3, r, n))]
        shapes.append((k, around(12, 11), [around(4, 5), around(9, 3)] if k % 2 else []))
    ring = lambda r: [{"x": x, "y": y} for x, y in r]
    d = spark.createDataFrame([(k, ring(o), [ring(h) for h in hs]) for k, o, hs in shapes], "k INT, outer ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>, holes ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>")

    def inside(r, x, y):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(r, r[1:] + r[:1])) % 2 == 1

    want = {}
    for k, o, hs in shapes:
        for i in range(25):
            for j in range(30):
                if inside(o, j + 0.5, i + 0.5):
                    want[i, j] = (not any(inside(h, j + 0.5, i + 0.5) for h in hs), k)
    got = {(r["i"], r["j"]): (r["lit"], r["top"]) for r in rasters.painted_polygons(d, "k", 25, 30).collect()}
    assert got == want


def test_box_totals_are_those_of_all_pairs(spark):
    """Crowded boxes and points on borders; 40,000 copies of each would make 1.6 billion pairs."""
    rng = random.Random(5)
    odd = [None, math.inf, -math.inf, math.nan]
    pts = [(float(rng.randrange(30)), float(rng.randrange(6)) * 2.5, rng.choice(odd) if rng.random() < 0.02 else rng.randrange(100) / 4) for _ in range(400)] + [(50.0, 50.0, None)]
    boxes = [(k, float(x := rng.randrange(-5, 30)), float(x + rng.randrange(-1, 9)), float(y := rng.randrange(-5, 15)), float(y + rng.randrange(6))) for k in range(60)] + [(99, 49.0, 51.0, 49.0, 51.0)]
    p = spark.createDataFrame(pts, "x DOUBLE, y DOUBLE, v DOUBLE")
    b = spark.createDataFrame(boxes, "b INT, x0 DOUBLE, x1 DOUBLE, y0 DOUBLE, y1 DOUBLE")
    got = {r["b"]: (r["n"], repr(r["total"])) for r in proximity.box_totals(p, b, "b", "v", 4.0).collect()}
    want = {}
    for k, x0, x1, y0, y1 in boxes:
        held = [v for x, y, v in pts if x0 <= x <= x1 and y0 <= y <= y1]
        if held:
            there = [v for v in held if v is not None]
            want[k] = (len(held), repr(sum(there) if there else None))
    assert got == want
    copies = lambda d: d.crossJoin(spark.range(40_000)).drop("id")
    crowd = proximity.box_totals(copies(p.filter("x = 50").withColumn("v", F.lit(0.5))), copies(b.filter("b = 99")).withColumn("b", F.monotonically_increasing_id()), "b", "v", 4.0)
    assert crowd.agg(F.count("b"), F.min("n"), F.max("n"), F.max("total")).first() == (40_000, 40_000, 40_000, 20_000.0)


def test_lattice_points_inside_are_those_contained(spark):
    """Random and concave rings, vertices on the lattice's rows and columns, rings beyond it, none and odd ones."""
    rng = random.Random(7)
    some = [[(rng.choice([0.5, 5.5, 10.5, rng.uniform(-10, 60)]), rng.choice([0.5, 5.5, 10.5, rng.uniform(-10, 50)])) for _ in range(rng.randrange(3, 9))] for _ in range(60)]
    some += [[(0.5, 0.5), (5.5, 0.5), (5.5, 10.5), (0.5, 10.5)], [(-1e300, -100.0), (1e300, -100.0), (1e300, 100.0), (-1e300, 100.0)], [(0.0, 0.0), (None, 0.0), (None, 9.0), (0.0, 9.0)], [(0.0, 0.0), (math.nan, 9.0), (3.0, 20.0)], []]
    d = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in r]) for k, r in enumerate(some)], "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    cells = d.withColumn("a", F.explode(F.array(*[F.lit(5.0 * i) for i in range(10)]))).withColumn("b", F.explode(F.array(*[F.lit(5.0 * j) for j in range(8)])))
    want = {r["k"]: r["n"] for r in cells.groupBy("k").agg(F.count_if(rings.contains(F.col("ring"), F.col("a") + 0.5, F.col("b") + 0.5)).alias("n")).collect()}
    assert {r["k"]: r["n"] for r in d.select("k", rings.lattice_points_inside(F.col("ring"), 0.5, 0.5, 5.0, 10, 8).alias("n")).collect()} == want and len(set(want.values())) > 10


@pytest.mark.parametrize("name", ["q_poly_raster", "q_polygon_mask_path"])
def test_rings_are_not_repeated_for_each_cell(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_least_rectangles_are_those_of_each_ring(spark):
    """Rings of one size together and alone: repeated points, lines, single places, convex and other rings."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 4, 5, 9):
        some = np.concatenate([rng.uniform(-9, 9, (60, n, 2)), rng.integers(0, 3, (200, n, 2)).astype(float)])
        want = np.array([shapes.least_rectangle(p) for p in some])
        got = shapes.least_rectangles(some)
        assert np.allclose(got, want, atol=1e-9)
    rows = [(k, r and [{"x": float(x), "y": float(y)} for x, y in r]) for k, r in enumerate([None, [], [(0, 0), (4, 0), (4, 3), (0, 3)], [(1, 1), (4, 5)], [(math.cos(a), math.sin(a)) for a in range(90)], [(2, 2)]])]
    d = spark.createDataFrame(rows, "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>").coalesce(1).select("k", shapes.bounding_rectangle(F.col("ring")).alias("b"))
    got = {r["k"]: r["b"] and (round(r["b"]["area"], 6), round(r["b"]["length"], 6)) for r in d.collect()}
    many = shapes.least_rectangle(np.array([(math.cos(a), math.sin(a)) for a in range(90)]))
    assert got[2] == (12, 4) and got[3] == (0, 5) and got[5] == (0, 0) and got[4] == (round(many[0], 6), round(many[2], 6))
    assert all(got[k] is None or got[k] == (None, None) for k in (0, 1))
