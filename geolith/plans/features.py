"""Map features as shapes: layers, buffers, painted polygons, lines on a grid, clipping, projections back, transport of colours, line fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import geo, rings
from geolith.functions.colour import roof_score, transport
from geolith.operators import rasters as R
from geolith.operators.proximity import cells_of_box
from geolith.plans.registry import Registry
from geolith.plans.tables import DAYS, HOURS, POINTS_SQL, RASTER_SQL, event_raster, table, vector_points
from geolith.plans.vectors import _utm, _utm_sql
from geolith.sources import osm

query = Registry()

@query("""
WITH e AS (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'way' WHEN 1 THEN 'relation' ELSE 'node' END AS type, CASE p_partkey % 7 WHEN 0 THEN 'water' WHEN 1 THEN 'wood' END AS nat,
  CASE p_partkey % 5 WHEN 0 THEN 'riverbank' WHEN 1 THEN 'dock' WHEN 2 THEN 'river' END AS waterway, CASE p_partkey % 11 WHEN 0 THEN 'reservoir' WHEN 1 THEN 'forest' END AS landuse, CASE p_partkey % 13 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS interm FROM part)
SELECT id, type, interm IS NOT DISTINCT FROM 'yes' AS intermittent FROM e WHERE type IN ('way', 'relation') AND (nat = 'water' OR waterway IN ('riverbank', 'dock') OR landuse = 'reservoir')
""")
def q_water_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of the water layer, from parts as tagged elements, and whether they run dry."""
    key = F.col("p_partkey")
    pick = lambda n, *values: F.element_at(F.array(*[F.lit(v) for v in values], *[F.lit(None).cast("string")] * (n - len(values))), (key % n + 1).cast("int"))
    tags = {"natural": pick(7, "water", "wood"), "waterway": pick(5, "riverbank", "dock", "river"), "landuse": pick(11, "reservoir", "forest"), "intermittent": pick(13, "yes", "no")}
    e = table(spark, sf_dir, "part").select(key.alias("id"), pick(3, "way", "relation", "node").alias("type"), F.map_filter(F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull()).alias("tags"))
    return osm.layer(e, "water").select("id", "type", osm.intermittent().alias("intermittent"))


#: Consecutive points as lines, of three classes.
LINES_SQL = "lines AS (SELECT a.vec_id AS k, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS ey, CAST(CASE a.src WHEN 0 THEN 8 WHEN 1 THEN 5 ELSE 2 END AS DOUBLE) AS w FROM points a JOIN points b ON b.vec_id = a.vec_id + 1)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vector_points(spark, sf_dir)
    to = p.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("bx"), F.col("y").alias("ey"))
    width = F.when(F.col("src") == 0, 8.0).when(F.col("src") == 1, 5.0).otherwise(2.0)
    return p.select("vec_id", F.col("x").alias("ax"), F.col("y").alias("ay"), width.alias("w")).join(to, "vec_id").withColumnRenamed("vec_id", "k")


def _distance_sql(x: str, y: str) -> str:
    t = f"least(greatest(coalesce((({x} - ax) * (bx - ax) + ({y} - ay) * (ey - ay)) / nullif((bx - ax) * (bx - ax) + (ey - ay) * (ey - ay), 0), 0), 0), 1)"
    return f"sqrt(pow({x} - ax - {t} * (bx - ax), 2) + pow({y} - ay - {t} * (ey - ay), 2))"


@query(f"""
WITH {POINTS_SQL}, {LINES_SQL}, s AS (SELECT * FROM lines WHERE k % 20 = 0)
SELECT k, round(w + 6, 6) AS width, round(sqrt(pow(bx - ax, 2) + pow(ey - ay, 2)) * (w + 6) + 3.141592653589793 * pow(w / 2 + 3, 2), 5) AS area, (SELECT count(*) FROM points p WHERE {_distance_sql("p.x", "p.y")} <= w / 2 + 3) AS points FROM s
""")
def q_line_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines widened by half their width and 3: the area of each and the points in it. Lines and points meet in grid cells."""
    lines = _lines(spark, sf_dir).filter("k % 20 = 0").withColumn("r", F.col("w") / 2 + 3)
    x0, x1 = F.least("ax", "bx") - F.col("r"), F.greatest("ax", "bx") + F.col("r")
    y0, y1 = F.least("ay", "ey") - F.col("r"), F.greatest("ay", "ey") + F.col("r")
    size = 8.0
    tiles = lines.withColumn("c", F.explode(cells_of_box(x0, y0, x1, y1, size))).select("*", "c.cx", "c.cy").drop("c")
    points = vector_points(spark, sf_dir).select("x", "y", F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy"))
    inside = rings.distance_to_segment(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("ey")) <= F.col("r")
    held = tiles.join(points, ["cx", "cy"]).filter(inside).groupBy("k").agg(F.count(F.lit(1)).alias("points"))
    area = F.hypot(F.col("bx") - F.col("ax"), F.col("ey") - F.col("ay")) * 2 * F.col("r") + F.lit(3.141592653589793) * F.col("r") * F.col("r")
    return lines.join(held, "k", "left").select("k", F.round(2 * F.col("r"), 6).alias("width"), F.round(area, 5).alias("area"), F.coalesce("points", F.lit(0)).alias("points"))


@query(f"""
WITH {POINTS_SQL}, {LINES_SQL}, c AS (SELECT i, j FROM range(-30, 30) a(i), range(-30, 30) b(j))
SELECT i, j, count(*) AS lines FROM c JOIN lines ON {_distance_sql("(j + 0.5)", "(i + 0.5)")} <= w / 2 GROUP BY i, j
""")
def q_line_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of side 1 whose centres lie within half a line's width of it, with the number of such lines."""
    lines = _lines(spark, sf_dir)
    cells = R.painted_lines(lines, 60, 60, -30.0, -30.0)
    return cells.groupBy((F.col("i") - 30).alias("i"), (F.col("j") - 30).alias("j")).agg(F.count(F.lit(1)).alias("lines"))


#: Parts as rectangles with a hole, moved about a grid of 60 x 60 cells; later parts are painted over earlier ones.
_PARTS_SQL = "p AS (SELECT p_partkey AS k, (p_partkey * 7 % 50)::DOUBLE AS x0, (p_partkey * 13 % 50)::DOUBLE AS y0, CAST(4 + p_size % 9 AS DOUBLE) AS w, CAST(4 + p_partkey % 6 AS DOUBLE) AS h FROM part)"


@query(f"""
WITH {_PARTS_SQL}, c AS (SELECT i, j, i + 0.5 AS y, j + 0.5 AS x FROM range(60) a(i), range(60) b(j)),
d AS (SELECT i, j, k, NOT (x > x0 + 1 AND x < x0 + w - 1 AND y > y0 + 1 AND y < y0 + h - 1) AS lit FROM c JOIN p ON x > x0 AND x < x0 + w AND y > y0 AND y < y0 + h)
SELECT i, j, arg_max(lit, k) AS lit, max(k) AS top FROM d GROUP BY i, j
""")
def q_painted_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons with holes on a grid in painter's order: the last polygon over a cell decides, as foreground or as its hole."""
    k, d = F.col("p_partkey"), lambda c: c.cast("double")
    p = table(spark, sf_dir, "part").select(k.alias("k"), d(k * 7 % 50).alias("x0"), d(k * 13 % 50).alias("y0"), d(4 + F.col("p_size") % 9).alias("w"), d(4 + k % 6).alias("h"))
    box = lambda m: F.array(*[rings.point(F.col("x0") + (F.col("w") - m if a else m), F.col("y0") + (F.col("h") - m if b else m)) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    shapes = p.select("k", box(F.lit(0.0)).alias("outer"), F.array(box(F.lit(1.0))).alias("holes"))
    return R.painted_polygons(shapes, "k", 60, 60).select("i", "j", "lit", "top")


@query(f"""
WITH {_PARTS_SQL}, t AS (SELECT CAST(a * 10 AS DOUBLE) AS tx, CAST(b * 10 AS DOUBLE) AS ty FROM range(6) q(a), range(6) s(b)),
o AS (SELECT k, tx, ty, least(x0 + w, tx + 10) - greatest(x0, tx) AS ow, least(y0 + h, ty + 10) - greatest(y0, ty) AS oh FROM p JOIN t ON x0 < tx + 10 AND x0 + w > tx AND y0 < ty + 10 AND y0 + h > ty)
SELECT tx, ty, count(*) AS n, round(sum(ow * oh), 5) AS area FROM o GROUP BY tx, ty
""")
def q_polygon_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons cut by the tiles they reach into: how many, and the area of their pieces."""
    k, d = F.col("p_partkey"), lambda c: c.cast("double")
    p = table(spark, sf_dir, "part").select(d(k * 7 % 50).alias("x0"), d(k * 13 % 50).alias("y0"), d(4 + F.col("p_size") % 9).alias("w"), d(4 + k % 6).alias("h"))
    x1, y1 = F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    ring = F.array(rings.point(F.col("x0"), F.col("y0")), rings.point(x1, F.col("y0")), rings.point(x1, y1), rings.point(F.col("x0"), y1))
    tiles = p.select(rings.edges(ring).alias("edges"), F.explode(cells_of_box(F.col("x0"), F.col("y0"), x1, y1, 10.0)).alias("c")).select("edges", (F.col("c.cx") * 10.0).alias("tx"), (F.col("c.cy") * 10.0).alias("ty"))
    area = rings.area_in_box(F.col("edges"), F.col("tx"), F.col("ty"), F.col("tx") + 10, F.col("ty") + 10)
    cut = tiles.filter("tx < 60 AND ty < 60").select("tx", "ty", F.explode(F.array(area)).alias("area"))  # explode: else each use of it computes it again
    return cut.groupBy("tx", "ty").agg(F.count_if(F.col("area") > 0).alias("n"), F.round(F.sum("area"), 5).alias("area")).filter("n > 0")


@query(f"WITH {_utm_sql()} SELECT s_suppkey, round(18.5 + (s_suppkey * 7919 % 5000) / 1000.0::DOUBLE, 7) AS lon, round(40.0 + (s_suppkey * 104729 % 3000) / 1000.0::DOUBLE, 7) AS lat FROM utm")
def q_utm_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places from their UTM coordinates: the SQL has the places that these were made of."""
    lon, lat = geo.utm_inverse(F.col("e"), F.col("n"), 34)
    return _utm(spark, sf_dir).select("s_suppkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def _root_sql(a: str, b: str, d: str, name: str) -> str:
    """Root of the symmetric matrix (a, b; b, d)."""
    det, tau = f"sqrt(({a}) * ({d}) - ({b}) * ({b}))", f"sqrt(({a}) + ({d}) + 2 * sqrt(({a}) * ({d}) - ({b}) * ({b})))"
    return f"(({a}) + {det}) / {tau} AS {name}a, ({b}) / {tau} AS {name}b, (({d}) + {det}) / {tau} AS {name}d"


@query(f"""
WITH {POINTS_SQL}, c AS (SELECT src, avg(x) AS mx, avg(y) AS my, var_pop(x) AS a, covar_pop(x, y) AS b, var_pop(y) AS d FROM points GROUP BY src), t AS (SELECT mx AS tmx, my AS tmy, a AS ta, b AS tb, d AS td FROM c WHERE src = 0),
h AS (SELECT *, {_root_sql("a", "b", "d", "h")} FROM c, t), m AS (SELECT *, ha * (ha * ta + hb * tb) + hb * (ha * tb + hb * td) AS ka, ha * (hb * ta + hd * tb) + hb * (hb * tb + hd * td) AS kb, hb * (hb * ta + hd * tb) + hd * (hb * tb + hd * td) AS kd FROM h),
r AS (SELECT *, {_root_sql("ka", "kb", "kd", "r")}, ha * hd - hb * hb AS q FROM m), v AS (SELECT *, hd / q AS va, -hb / q AS vb, ha / q AS vd FROM r),
w AS (SELECT *, va * (va * ra + vb * rb) + vb * (va * rb + vb * rd) AS wa, va * (vb * ra + vd * rb) + vb * (vb * rb + vd * rd) AS wb, vb * (vb * ra + vd * rb) + vd * (vb * rb + vd * rd) AS wd FROM v)
SELECT vec_id, round(tmx + wa * (x - mx) + wb * (y - my), 4) AS x, round(tmy + wb * (x - mx) + wd * (y - my), 4) AS y FROM points JOIN w USING (src)
""")
def q_cov_transport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points moved so that their source's mean and whole covariance become those of source 0."""
    p = vector_points(spark, sf_dir)
    c = p.groupBy("src").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("a"), F.covar_pop("x", "y").alias("b"), F.var_pop("y").alias("d"))
    to = c.filter("src = 0").select(*[F.col(k).alias(f"t{k}") for k in ("mx", "my", "a", "b", "d")])  # one row
    wa, wb, wd = transport(*[F.col(k) for k in ("a", "b", "d", "ta", "tb", "td")])
    moves = c.join(to).select("src", "mx", "my", "tmx", "tmy", wa.alias("wa"), wb.alias("wb"), wd.alias("wd"))
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    return p.join(moves, "src").select("vec_id", F.round(F.col("tmx") + F.col("wa") * dx + F.col("wb") * dy, 4).alias("x"), F.round(F.col("tmy") + F.col("wb") * dx + F.col("wd") * dy, 4).alias("y"))


def _fit_sql(source: str, name: str) -> str:
    return f"{name} AS (SELECT src, avg(x) AS mx, avg(y) AS my, 0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS a, count(*) AS n FROM {source} GROUP BY src)"


def _near_sql(fitted: str, window: float, name: str) -> str:
    return f"{name} AS (SELECT p.* FROM points p JOIN {fitted} f USING (src) WHERE abs((p.y - f.my) * cos(f.a) - (p.x - f.mx) * sin(f.a)) <= {window})"


@query(f"WITH {POINTS_SQL}, {_fit_sql('points', 'f0')}, {_near_sql('f0', 12.0, 'n1')}, {_fit_sql('n1', 'f1')}, {_near_sql('f1', 6.0, 'n2')}, {_fit_sql('n2', 'f2')}, {_near_sql('f2', 3.0, 'n3')}, {_fit_sql('n3', 'f3')} SELECT src, round(mx, 5) AS mx, round(my, 5) AS my, round(degrees(a), 4) AS axis, n FROM f3")
def q_axis_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line through each source's points, fitted again to those within 12, 6 and 3 of the one before."""
    p = vector_points(spark, sf_dir)
    angle = F.atan2(2 * F.covar_pop("x", "y"), F.var_pop("x") - F.var_pop("y")) / 2
    fit = lambda rows: rows.groupBy("src").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), angle.alias("a"), F.count(F.lit(1)).alias("n"))
    fitted = fit(p)
    for window in (12.0, 6.0, 3.0):
        across = (F.col("y") - F.col("my")) * F.cos("a") - (F.col("x") - F.col("mx")) * F.sin("a")
        fitted = fit(p.join(fitted.drop("n"), "src").filter(F.abs(across) <= window))
    return fitted.select("src", F.round("mx", 5).alias("mx"), F.round("my", 5).alias("my"), F.round(F.degrees("a"), 4).alias("axis"), "n")


@query(f"""
WITH {RASTER_SQL}, t AS (SELECT i, j, 2100 + (z - 45) * 20 AS elev, CASE WHEN j % 3 = 0 THEN 2 ELSE 1 END AS kind, ((i * 73 + j * 151) % 97) / 97.0 AS chance FROM raster)
SELECT i, j, CASE WHEN elev > 2300 THEN 0 WHEN elev >= 2100 AND chance < (elev - 2100) / 200 THEN 0 ELSE kind END AS kind FROM t
""")
def q_treeline_fade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest thins out between 2100 and 2300 metres, by a chance that grows with the height, and ends there."""
    t = event_raster(spark, sf_dir).select("i", "j", (F.lit(2100.0) + (F.col("z") - 45) * 20).alias("elev"), F.when(F.col("j") % 3 == 0, 2).otherwise(1).alias("kind"), ((F.col("i") * 73 + F.col("j") * 151) % 97 / 97.0).alias("chance"))
    faded = (F.col("elev") > 2300) | ((F.col("elev") >= 2100) & (F.col("chance") < geo.ramp(F.col("elev"), 2100.0, 2300.0)))
    return t.select("i", "j", F.when(faded, 0).otherwise(F.col("kind")).alias("kind"))


@query(f"""
WITH {RASTER_SQL}, m AS (SELECT i, j FROM raster WHERE z > 48), o AS (SELECT i, j FROM raster WHERE NOT z > 48), d AS (
  SELECT r.i, r.j, r.z > 48 AS inside, (SELECT min((r.i - m.i) * (r.i - m.i) + (r.j - m.j) * (r.j - m.j)) FROM m) AS d_in, (SELECT min((r.i - o.i) * (r.i - o.i) + (r.j - o.j) * (r.j - o.j)) FROM o) AS d_out FROM raster r),
s AS (SELECT i, j, CASE WHEN inside THEN sqrt(d_out) ELSE -sqrt(d_in) END AS d FROM d), t AS (SELECT *, least(greatest((d + 2) / 4, 0), 1) AS t FROM s)
SELECT i, j, round(d, 6) AS d, round(t * t * (3 - 2 * t), 6) AS alpha FROM t
""")
def q_signed_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance to the edge of a mask, negative outside, and a feathered alpha across it."""
    r = event_raster(spark, sf_dir)
    mask, rest = r.filter("z > 48"), r.filter("NOT z > 48")
    d = r.join(R.distances(rest, DAYS, HOURS).withColumnRenamed("d2", "d_out"), ["i", "j"], "left").join(R.distances(mask, DAYS, HOURS).withColumnRenamed("d2", "d_in"), ["i", "j"], "left")
    d = d.select("i", "j", F.when(F.col("z") > 48, F.sqrt("d_out")).otherwise(-F.sqrt("d_in")).alias("d"))
    return d.select("i", "j", F.round("d", 6).alias("d"), F.round(geo.smoothstep(F.col("d"), -2.0, 2.0), 6).alias("alpha"))


@query("""
WITH c AS (SELECT vec_id, least(greatest(CAST(embedding[3] AS DOUBLE) + 0.5, 0), 1) AS r, least(greatest(CAST(embedding[4] AS DOUBLE) + 0.5, 0), 1) AS g, least(greatest(CAST(embedding[5] AS DOUBLE) + 0.5, 0), 1) AS b FROM embeddings)
SELECT vec_id, round(least(greatest((r + g + b) / 3 * least(greatest(0.15 - (g - (r + b) / 2), 0), 1) * 6, 0), 1), 6) AS score FROM c
""")
def q_roof_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = lambda k: F.least(F.greatest(F.col("embedding")[k].cast("double") + 0.5, F.lit(0.0)), F.lit(1.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(roof_score(unit(2), unit(3), unit(4)), 6).alias("score"))
