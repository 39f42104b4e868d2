"""Boundaries as rings: traced masks, unions of polygons, repaired rings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import rings
from geolith.operators import boundaries as B
from geolith.plans.registry import Registry
from geolith.plans.tables import HOURS, RASTER_SQL, event_raster, table
from geolith.sources import mesh

query = Registry()


def _rings_sql(width: int) -> str:
    """Rings of the mask m (i, j): sides, the side after each by the turning rule, and a walk along them from each one."""
    return f"""
s AS (SELECT * FROM (VALUES (-1, 0, 0, 0, 0), (0, 1, 0, 1, 1), (1, 0, 1, 1, 2), (0, -1, 1, 0, 3)) v(a, b, di, dj, d)),
e AS MATERIALIZED (SELECT m.i + di AS i, m.j + dj AS j, d, ((m.i + di) * {width + 1} + m.j + dj)::BIGINT * 4 + d AS id FROM m, s WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.i = m.i + a AND o.j = m.j + b)),
n AS MATERIALIZED (SELECT a.id, arg_min(b.id, (b.d - a.d + 3) % 4) AS next, arg_min(b.d, (b.d - a.d + 3) % 4) <> a.d AS turns FROM e a JOIN e b ON b.i = a.i + CASE a.d WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AND b.j = a.j + CASE a.d WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END GROUP BY a.id, a.d),
w AS (SELECT id, next AS spot, 1 AS k FROM n UNION ALL SELECT w.id, n.next, k + 1 FROM w JOIN n ON n.id = w.spot WHERE w.spot <> w.id),
l AS MATERIALIZED (SELECT id, min(spot) AS ring, max(k) AS n, arg_min(k, spot) AS ahead FROM w GROUP BY id),
c AS MATERIALIZED (SELECT e.*, l.ring, (n - ahead) % n AS step, p.turns AS corner, sum(CASE d WHEN 1 THEN e.j WHEN 3 THEN -e.j ELSE 0 END) OVER (PARTITION BY l.ring) AS area FROM e JOIN l USING (id) JOIN n p ON p.next = e.id)"""


@query(f"""
WITH RECURSIVE {RASTER_SQL}, m AS (SELECT i, j FROM raster WHERE z > 50), {_rings_sql(HOURS)}
SELECT ring, (row_number() OVER (PARTITION BY ring ORDER BY step) - 1)::INT AS place, i, j, area < 0 AS hole FROM c WHERE corner
""")
def q_mask_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outlines of a mask's regions as rings of corners in order, and which of them are holes."""
    mask = event_raster(spark, sf_dir).filter("z > 50").select("i", "j")
    return B.mask_rings(mask, HOURS)


#: Parts as rectangles and L shapes on a plane of 1000 x 1000 cells.
SIDE = 1000
_SHAPES_SQL = f"p AS (SELECT p_partkey AS k, (p_partkey * 7919) % {SIDE - 20} AS x0, (p_partkey * 104729) % {SIDE - 20} AS y0, 4 + p_size % 9 AS w, 4 + p_partkey % 6 AS h, p_partkey % 3 = 0 AS l FROM part)"


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, ring): every third has lost its upper right quarter."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("k"), (k * 7919 % (SIDE - 20)).alias("x0"), (k * 104729 % (SIDE - 20)).alias("y0"), (4 + F.col("p_size") % 9).cast("long").alias("w"), (4 + k % 6).alias("h"))
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    xm, ym = x0 + 2, y0 + 2
    box = F.array(*[rings.point(*v) for v in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
    notched = F.array(*[rings.point(*v) for v in ((x0, y0), (x1, y0), (x1, ym), (xm, ym), (xm, y1), (x0, y1))])
    return p.select("k", F.when(F.col("k") % 3 == 0, notched).otherwise(box).alias("ring"))


@query(f"""
WITH RECURSIVE {_SHAPES_SQL}, m AS MATERIALIZED (SELECT DISTINCT i::INT AS i, j::INT AS j FROM (SELECT y0 + unnest(range(h)) AS i, * FROM p) r, LATERAL (SELECT x0 + unnest(range(w)) AS j) c WHERE NOT (l AND i >= y0 + 2 AND j >= x0 + 2)), {_rings_sql(SIDE)}
SELECT min(j)::DOUBLE AS x0, min(i)::DOUBLE AS y0, max(j)::DOUBLE AS x1, max(i)::DOUBLE AS y1, count(*) FILTER (WHERE corner) AS corners, any_value(area)::DOUBLE AS area, any_value(area) < 0 AS hole FROM c GROUP BY ring
""")
def q_polygon_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What rectangles and L shapes cover together, as rings: the box, corners and area of each."""
    found = B.union(_shapes(spark, sf_dir), "k", "ring", 8.0, 1e-3)
    box = [f(c).alias(f"{c}{n}") for c in "xy" for f, n in ((F.min, 0), (F.max, 1))]
    rounded = [F.round(c, 3).alias(c) for c in ("x0", "y0", "x1", "y1", "area")]
    return found.groupBy("ring").agg(*box, F.count(F.lit(1)).alias("corners"), F.first("area").alias("area")).select(*rounded, "corners", (F.col("area") < 0).alias("hole"))


@query("""
WITH p AS (SELECT p_partkey AS k, p_partkey % 6 AS kind, 2 * (2 + p_size % 9)::DOUBLE AS w, 2 * (2 + p_partkey % 7)::DOUBLE AS h FROM part),
r AS (SELECT k, CASE kind WHEN 1 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS rings, CASE kind WHEN 1 THEN 6 WHEN 4 THEN 0 WHEN 5 THEN 4 ELSE 4 END AS corners, CASE kind WHEN 1 THEN w * h / 2 WHEN 4 THEN 0 ELSE w * h END AS area FROM p)
SELECT k, rings, corners, area FROM r
""")
def q_ring_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that cross themselves, double a vertex, have a spike or go round twice, by the even-odd rule: rings, corners and area of each."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("k"), (k % 6).alias("kind"), (2 * (2 + F.col("p_size") % 9)).cast("double").alias("w"), (2 * (2 + k % 7)).cast("double").alias("h"))
    w, h, zero = F.col("w"), F.col("h"), F.lit(0.0)
    ring = lambda *points: F.array(*[rings.point(x, y) for x, y in points])
    a, b, c, d = (zero, zero), (w, zero), (w, h), (zero, h)
    kinds = [ring(a, b, c, d), ring(a, c, b, d), ring(a, b, b, c, d, d, a), ring(a, b, (w + 5, zero), b, c, d), ring(a, b, c, d, a, b, c, d), ring(d, c, (w, h / 2), b, a)]  # the last goes the other way round
    broken: Column = F.element_at(F.array(*kinds), (F.col("kind") + 1).cast("int"))
    p = p.select("k", broken.alias("ring"))
    each = B.repaired(p, "k", "ring", 16.0).groupBy("k", "ring").agg(F.count(F.lit(1)).alias("n"), F.first("area").alias("area"))
    by_part = each.groupBy("k").agg(F.count(F.lit(1)).cast("int").alias("rings"), F.sum("n").cast("int").alias("corners"), F.round(F.sum("area"), 3).alias("area"))
    return p.select("k").join(by_part, "k", "left").select("k", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rings", "corners")], F.coalesce("area", F.lit(0.0)).alias("area"))


@query(f"""
WITH {_SHAPES_SQL}, v AS MATERIALIZED (SELECT k, n, x::DOUBLE AS x, y::DOUBLE AS y FROM (SELECT k, unnest([1, 2, 3, 4, 5, 6]) AS n, unnest([x0, x0 + w, x0 + w, x0 + 2, x0 + 2, x0]) AS x, unnest([y0, y0, y0 + 2, y0 + 2, y0 + h, y0 + h]) AS y FROM p WHERE l
  UNION ALL SELECT k, unnest([1, 2, 3, 4]), unnest([x0, x0 + w, x0 + w, x0]), unnest([y0, y0, y0 + h, y0 + h]) FROM p WHERE NOT l)),
d AS (SELECT a.k, a.n, b.n AS m, (b.x - a.x) / sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS ux, (b.y - a.y) / sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS uy FROM v a JOIN v b ON a.k = b.k AND b.n > a.n),
r AS (SELECT d.k, (max(x * ux + y * uy) - min(x * ux + y * uy)) * (max(y * ux - x * uy) - min(y * ux - x * uy)) AS area FROM d JOIN v USING (k) GROUP BY d.k, d.n, d.m),
o AS (SELECT k, min(area) AS area FROM r GROUP BY k), s AS (SELECT k, o.area, CASE WHEN l THEN w * h - (w - 2) * (h - 2) ELSE w * h END AS own FROM o JOIN p USING (k))
SELECT k, own >= 0.75 * area * (1 - 1e-9) AS snapped, round(CASE WHEN own >= 0.75 * area * (1 - 1e-9) THEN area ELSE own END, 4) AS area FROM s
""")
def q_rectangle_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that fill three quarters of their smallest rectangle become it; others stay."""
    found = B.snapped(_shapes(spark, sf_dir), "k", "ring", 0.75)
    return found.select("k", "snapped", F.round(F.abs(rings.signed_area(F.col("ring"))), 4).alias("area"))


@query(f"""
WITH {_SHAPES_SQL}, b AS (SELECT printf('model-%d', k % 37) AS path, k, w::DOUBLE AS w, h::DOUBLE AS h, 3.0 + k % 5 AS z FROM p)
SELECT path, count(*) AS objects, sum(10)::BIGINT AS triangles, round(sum(2 * (w + h) * z + w * h), 3) AS area FROM b GROUP BY path
""")
def q_model_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as boxes with walls and a roof, written as models of many objects and read back: objects, triangles and surface of each."""
    k = F.col("k")
    shapes = _shapes(spark, sf_dir)
    box = lambda f, axis: f(F.transform("ring", lambda p: p[axis]))
    corners = [(F.array_min, F.array_min), (F.array_max, F.array_min), (F.array_max, F.array_max), (F.array_min, F.array_max)]
    ring = F.array(*[rings.point(box(fx, "x"), box(fy, "y")) for fx, fy in corners])
    models = shapes.select(F.format_string("model-%d", k % 37).alias("path"), k.alias("place"), F.format_string("part %d", "k").alias("name"), F.lit("wall.png").alias("texture"), ring.alias("ring"), (3.0 + k % 5).alias("height"))
    files = mesh.encoded(models)
    objects = mesh.objects(files).groupBy("path").agg(F.count(F.lit(1)).alias("objects"))
    return objects.join(mesh.surface_area(mesh.triangles(files)), "path").select("path", "objects", "triangles", F.round("area", 3).alias("area"))
