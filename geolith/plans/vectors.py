"""Vector queries: projections, rings, oriented rectangles, colour statistics, tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import geo, rings
from geolith.functions.colour import lab, moved
from geolith.operators.rasters import bilinear
from geolith.operators.ranking import numbered, percentiles
from geolith.plans.registry import Registry
from geolith.plans.tables import DAYS, HOURS, POINTS_SQL, RASTER_SQL, event_raster, part_rings, table, vector_points

query = Registry()


def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, lon, lat, heading): invented places near 21 degrees east."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", (F.lit(18.5) + (k * 7919 % 5000) / 1000.0).alias("lon"), (F.lit(40.0) + (k * 104729 % 3000) / 1000.0).alias("lat"), ((k * 53) % 360).cast("double").alias("heading"))


PLACES_SQL = "places AS (SELECT s_suppkey, 18.5 + (s_suppkey * 7919 % 5000) / 1000.0::DOUBLE AS lon, 40.0 + (s_suppkey * 104729 % 3000) / 1000.0::DOUBLE AS lat, ((s_suppkey * 53) % 360)::DOUBLE AS heading FROM supplier)"


def _utm_sql() -> str:
    radius, ecc, alpha = geo.third_flattening()
    north = " + ".join(f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(alpha, 1))
    east = " + ".join(f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(alpha, 1))
    return f"""{PLACES_SQL}, a AS (SELECT *, radians(lat) AS phi, radians(lon - 21) AS lam FROM places),
t AS (SELECT *, sinh(atanh(sin(phi)) - {ecc!r} * atanh({ecc!r} * sin(phi))) AS t FROM a), x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t),
utm AS (SELECT s_suppkey, heading, 500000 + {geo.SCALE * radius!r} * (eta + {east}) AS e, {geo.SCALE * radius!r} * (xi + {north}) AS n FROM x)"""


def _utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = geo.utm_forward(F.col("lon"), F.col("lat"), 34)
    return supplier_places(spark, sf_dir).select("s_suppkey", "heading", e.alias("e"), n.alias("n"))


@query(f"WITH {_utm_sql()} SELECT s_suppkey, round(e, 4) AS e, round(n, 4) AS n FROM utm")
def q_utm_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utm(spark, sf_dir).select("s_suppkey", F.round("e", 4).alias("e"), F.round("n", 4).alias("n"))


@query(f"""
WITH {PLACES_SQL} SELECT s_suppkey, CAST(trunc((lon + 180) / 360 * 4096) AS INT) AS tx, CAST(trunc((1 - asinh(tan(radians(lat))) / 3.141592653589793) / 2 * 4096) AS INT) AS ty FROM places
""")
def q_slippy_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, ty = geo.slippy_tile(F.col("lon"), F.col("lat"), 12)
    return supplier_places(spark, sf_dir).select("s_suppkey", tx.alias("tx"), ty.alias("ty"))


@query(f"""
WITH {_utm_sql()}, c AS (SELECT s_suppkey, k, e + sin(radians(heading)) * 600 * s + cos(radians(heading)) * 50 * t AS x, n + cos(radians(heading)) * 600 * s - sin(radians(heading)) * 50 * t AS y
FROM utm, (VALUES (0, 1, 1), (1, 1, -1), (2, -1, -1), (3, -1, 1)) v(k, s, t))
SELECT s_suppkey, k, round(x, 3) AS x, round(y, 3) AS y FROM c
""")
def q_oriented_rect(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = rings.oriented_rectangle(F.col("e"), F.col("n"), F.col("heading"), F.lit(1200.0), F.lit(100.0))
    return _utm(spark, sf_dir).select("s_suppkey", F.posexplode(ring).alias("k", "p")).select("s_suppkey", "k", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


RING_SQL = "rings AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS w, CAST(p_partkey % 40 AS DOUBLE) AS h, CAST((p_partkey * 37) % 360 AS DOUBLE) AS heading FROM part)"


@query(f"""
WITH {RING_SQL} SELECT p_partkey, round(w * h, 6) AS area, round(2 * (w + h), 6) AS length, CASE WHEN w * h = 0 THEN NULL ELSE round(w / 2, 6) END AS cx, CASE WHEN w * h = 0 THEN NULL ELSE round(h / 2, 6) END AS cy,
       CAST(CASE WHEN w >= h THEN 0 ELSE 90 END AS DOUBLE) AS bearing FROM rings
""")
def q_ring_area_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = F.col("ring")
    cx, cy = rings.centroid(ring)
    return part_rings(spark, sf_dir).select("p_partkey", F.round(rings.signed_area(ring), 6).alias("area"), F.round(rings.perimeter(ring), 6).alias("length"), F.round(cx, 6).alias("cx"), F.round(cy, 6).alias("cy"), F.round(rings.longest_edge_bearing(ring), 6).alias("bearing"))


@query(f"WITH {RING_SQL} SELECT p_partkey, w > 0 AND h > 0 AS valid, CAST(CASE WHEN w > 0 AND h > 0 THEN 4 WHEN w > 0 OR h > 0 THEN 2 ELSE 1 END AS INT) AS vertices FROM rings")
def q_shape_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_rings(spark, sf_dir).select("p_partkey", rings.valid(F.col("ring")).alias("valid"), F.size(F.array_distinct("ring")).alias("vertices"))


@query(f"""
WITH {RING_SQL}, p AS (SELECT p_partkey, k, heading, CASE WHEN k IN (1, 2) THEN w ELSE 0 END - w / 2 AS x, CASE WHEN k IN (2, 3) THEN h ELSE 0 END - h / 2 AS y FROM rings, (VALUES (0), (1), (2), (3)) v(k) WHERE w > 0 AND h > 0)
SELECT p_partkey, k, round(x * cos(radians(heading)) + y * sin(radians(heading)), 5) AS x, round(y * cos(radians(heading)) - x * sin(radians(heading)), 5) AS y FROM p
""")
def q_rotate_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = part_rings(spark, sf_dir).filter(rings.valid(F.col("ring")))
    cx, cy = rings.centroid(F.col("ring"))
    p = d.select("p_partkey", "heading", F.posexplode(rings.local_frame(F.col("ring"), cx, cy)).alias("k", "p"))
    x, y = geo.rotate(F.col("p.x"), F.col("p.y"), F.col("heading"))
    return p.select("p_partkey", "k", F.round(x, 5).alias("x"), F.round(y, 5).alias("y"))


@query(f"""
WITH {RING_SQL}, t AS (SELECT p_partkey, w, h, a + 0.5 AS x, b + 0.5 AS y FROM rings, range(0, 50, 5) q(a), range(0, 40, 5) s(b)) SELECT p_partkey, count(*) AS pixels FROM t WHERE x < w AND y < h GROUP BY p_partkey
""")
def q_poly_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = part_rings(spark, sf_dir)
    pixels = d.select("p_partkey", rings.lattice_points_inside(F.col("ring"), 0.5, 0.5, 5.0, 10, 8).alias("pixels"))
    return pixels.groupBy("p_partkey").agg(F.sum("pixels").alias("pixels")).filter("pixels > 0")


@query(f"""
WITH {POINTS_SQL}, s AS (SELECT a.vec_id, a.x AS ax, a.y AS ay, b.x AS ex, b.y AS ey FROM points a JOIN points b ON b.vec_id = a.vec_id + 1),
t AS (SELECT *, greatest(least((-10 - ax) / nullif(ex - ax, 0), (10 - ax) / nullif(ex - ax, 0)), least((-10 - ay) / nullif(ey - ay, 0), (10 - ay) / nullif(ey - ay, 0)), 0) AS lo,
  least(greatest((-10 - ax) / nullif(ex - ax, 0), (10 - ax) / nullif(ex - ax, 0)), greatest((-10 - ay) / nullif(ey - ay, 0), (10 - ay) / nullif(ey - ay, 0)), 1) AS hi FROM s)
SELECT vec_id, round(greatest(hi - lo, 0) * sqrt((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)), 5) AS inside,
       round(sqrt(pow(0 - ax - least(greatest((-ax * (ex - ax) - ay * (ey - ay)) / ((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)), 0), 1) * (ex - ax), 2) + pow(0 - ay - least(greatest((-ax * (ex - ax) - ay * (ey - ay)) / ((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)), 0), 1) * (ey - ay), 2)), 5) AS distance FROM t
""")
def q_line_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vector_points(spark, sf_dir)
    s = p.select("vec_id", F.col("x").alias("ax"), F.col("y").alias("ay")).join(p.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("bx"), F.col("y").alias("by")), "vec_id")
    ends = [F.col(c) for c in ("ax", "ay", "bx", "by")]
    box = [F.lit(v) for v in (-10.0, -10.0, 10.0, 10.0)]
    return s.select("vec_id", F.round(rings.clipped_length(*ends, *box), 5).alias("inside"), F.round(rings.distance_to_segment(F.lit(0.0), F.lit(0.0), *ends), 5).alias("distance"))


@query("""
WITH a AS (SELECT user_id, value AS w, radians(2 * (hour(ts) * 7.5)) AS a FROM events) SELECT user_id, round(((degrees(atan2(sum(w * sin(a)), sum(w * cos(a)))) / 2) % 180 + 180) % 180, 5) AS axis FROM a GROUP BY user_id
""")
def q_circular_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.radians(F.hour("ts") * 15.0)
    axis = F.degrees(F.atan2(F.sum(F.col("value") * F.sin(a)), F.sum(F.col("value") * F.cos(a)))) / 2
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.pmod(axis, F.lit(180.0)), 5).alias("axis"))


@query(f"""
WITH {PLACES_SQL} SELECT s_suppkey, round((((47.0 - heading + 90) % 180) + 180) % 180 - 90, 6) AS difference, round(((degrees(atan2(lon - 21, lat - 41.5)) % 360) + 360) % 360, 5) AS azimuth FROM places
""")
def q_axis_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_places(spark, sf_dir).select("s_suppkey", F.round(geo.axis_difference(F.col("heading"), F.lit(47.0)), 6).alias("difference"), F.round(geo.azimuth(F.col("lon") - 21, F.col("lat") - 41.5), 5).alias("azimuth"))


@query("""
WITH m AS (SELECT event_type, median(value) AS mid FROM events GROUP BY 1), d AS (SELECT e.event_type, event_id, value, mid, abs(value - mid) AS dev FROM events e JOIN m ON m.event_type = e.event_type), k AS (SELECT event_type, 1.4826 * median(dev) AS mad FROM d GROUP BY 1)
SELECT event_id, round((value - mid) / nullif(mad, 0), 6) AS z FROM d JOIN k USING (event_type) WHERE abs((value - mid) / nullif(mad, 0)) > 4
""")
def q_mad_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    middle = lambda rows, c, name: percentiles(rows, "event_type", c, [0.5], 1.0).select("event_type", F.col("p")[0].alias(name))
    d = e.join(middle(e, "value", "mid"), "event_type").withColumn("dev", F.abs(F.col("value") - F.col("mid")))
    z = (F.col("value") - F.col("mid")) / F.nullif(F.col("mad"), F.lit(0.0))
    spread = middle(d, "dev", "mad").withColumn("mad", F.col("mad") * 1.4826)
    return d.join(spread, "event_type").filter(F.abs(z) > 4).select("event_id", F.round(z, 6).alias("z"))


@query(f"""
WITH {POINTS_SQL}, s AS (SELECT src, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy FROM points GROUP BY src), t AS (SELECT * FROM s WHERE src = 0)
SELECT vec_id, round((p.x - s.mx) / nullif(s.sx, 0) * t.sx + t.mx, 5) AS x, round((p.y - s.my) / nullif(s.sy, 0) * t.sy + t.my, 5) AS y FROM points p JOIN s USING (src), t
""")
def q_cov_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vector_points(spark, sf_dir)
    s = p.groupBy("src").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"))
    to = s.filter("src = 0").select(*[F.col(c).alias(f"t{c}") for c in ("mx", "my", "sx", "sy")])
    d = p.join(s.join(to, how="left"), "src")  # one row beside the sources' own
    m = lambda c: F.round(moved(F.col(c), F.col(f"m{c}"), F.col(f"s{c}"), F.col(f"tm{c}"), F.col(f"ts{c}")), 5).alias(c)
    return d.select("vec_id", m("x"), m("y"))


@query(f"""
WITH {POINTS_SQL}, c AS (SELECT src, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS d, corr(x, y) AS r, count(*) AS n FROM points GROUP BY src),
e AS (SELECT *, (a + d) / 2 + sqrt(pow((a - d) / 2, 2) + b * b) AS big, (a + d) / 2 - sqrt(pow((a - d) / 2, 2) + b * b) AS small FROM c)
SELECT src, n, round(r, 6) AS corr, round(big, 5) AS big, round(small, 5) AS small, round(degrees(atan2(2 * b, a - d)) / 2, 5) AS axis FROM e
""")
def q_reinhard_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = vector_points(spark, sf_dir).groupBy("src").agg(F.var_samp("x").alias("a"), F.covar_samp("x", "y").alias("b"), F.var_samp("y").alias("d"), F.corr("x", "y").alias("r"), F.count(F.lit(1)).alias("n"))
    half, root = (F.col("a") + F.col("d")) / 2, F.sqrt(F.pow((F.col("a") - F.col("d")) / 2, F.lit(2)) + F.col("b") * F.col("b"))
    return c.select("src", "n", F.round("r", 6).alias("corr"), F.round(half + root, 5).alias("big"), F.round(half - root, 5).alias("small"), F.round(F.degrees(F.atan2(F.col("b") * 2, F.col("a") - F.col("d"))) / 2, 5).alias("axis"))


@query("""
WITH c AS (SELECT vec_id, CAST(embedding[3] AS DOUBLE) + 0.5 AS r, CAST(embedding[4] AS DOUBLE) + 0.5 AS g, CAST(embedding[5] AS DOUBLE) + 0.5 AS b FROM embeddings),
k AS (SELECT vec_id, least(greatest(r, 0), 1) AS r, least(greatest(g, 0), 1) AS g, least(greatest(b, 0), 1) AS b FROM c),
l AS (SELECT vec_id, CASE WHEN r <= 0.04045 THEN r / 12.92 ELSE pow((r + 0.055) / 1.055, 2.4) END AS r, CASE WHEN g <= 0.04045 THEN g / 12.92 ELSE pow((g + 0.055) / 1.055, 2.4) END AS g, CASE WHEN b <= 0.04045 THEN b / 12.92 ELSE pow((b + 0.055) / 1.055, 2.4) END AS b FROM k),
x AS (SELECT vec_id, (0.4124564 * r + 0.3575761 * g + 0.1804375 * b) / 0.95047 AS x, (0.2126729 * r + 0.7151522 * g + 0.0721750 * b) AS y, (0.0193339 * r + 0.1191920 * g + 0.9503041 * b) / 1.08883 AS z FROM l),
f AS (SELECT vec_id, CASE WHEN x > 216.0 / 24389 THEN cbrt(x) ELSE (24389.0 / 27 * x + 16) / 116 END AS x, CASE WHEN y > 216.0 / 24389 THEN cbrt(y) ELSE (24389.0 / 27 * y + 16) / 116 END AS y, CASE WHEN z > 216.0 / 24389 THEN cbrt(z) ELSE (24389.0 / 27 * z + 16) / 116 END AS z FROM x)
SELECT vec_id, round(116 * y - 16, 4) AS l, round(500 * (x - y), 4) AS a, round(200 * (y - z), 4) AS b FROM f
""")
def q_lab_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = lambda k: F.least(F.greatest(F.col("embedding")[k].cast("double") + 0.5, F.lit(0.0)), F.lit(1.0))
    light, a, b = lab(unit(2), unit(3), unit(4))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(light, 4).alias("l"), F.round(a, 4).alias("a"), F.round(b, 4).alias("b"))


@query(f"""
WITH RECURSIVE {POINTS_SQL}, u AS (SELECT vec_id, least(greatest((x + 40) / 80, 0), 0.999999) AS x, least(greatest((y + 40) / 80, 0), 0.999999) AS y FROM points),
q AS (SELECT 0 AS depth, 0 AS tx, 0 AS ty, (SELECT count(*) FROM u) AS n UNION ALL
  SELECT q.depth + 1, q.tx * 2 + a, q.ty * 2 + b, (SELECT count(*) FROM u WHERE floor(u.x * pow(2, q.depth + 1)) = q.tx * 2 + a AND floor(u.y * pow(2, q.depth + 1)) = q.ty * 2 + b) FROM q, (VALUES (0), (1)) s(a), (VALUES (0), (1)) t(b) WHERE q.n > 40 AND q.depth < 4)
SELECT depth, tx, ty, n FROM q WHERE n > 0 AND (n <= 40 OR depth = 4)
""")
def q_quad_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of at most 40 points, or of depth 4: a tile splits while it and all tiles above it hold more."""
    unit = lambda c: F.least(F.greatest((F.col(c) + 40) / 80, F.lit(0.0)), F.lit(0.999999))
    p = vector_points(spark, sf_dir).select(unit("x").alias("x"), unit("y").alias("y"))
    levels = p.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumns({"tx": F.floor(F.col("x") * F.pow(F.lit(2), F.col("depth"))).cast("int"), "ty": F.floor(F.col("y") * F.pow(F.lit(2), F.col("depth"))).cast("int")})
    tiles = levels.groupBy("depth", "tx", "ty").agg(F.count(F.lit(1)).alias("n"))
    above = tiles.select((F.col("depth") + 1).alias("depth"), F.col("tx").alias("px"), F.col("ty").alias("py"), F.col("n").alias("held"))
    with_parent = tiles.withColumns({"px": F.floor(F.col("tx") / 2).cast("int"), "py": F.floor(F.col("ty") / 2).cast("int")}).join(above, ["depth", "px", "py"], "left")
    split = (F.col("held") > 40) | F.col("held").isNull()
    return with_parent.filter(split & ((F.col("n") <= 40) | (F.col("depth") == 4))).select("depth", "tx", "ty", "n")


@query("SELECT n_nationkey AS c, r_regionkey AS r, CAST(110000 - (n_nationkey + 1) * 5760 AS DOUBLE) AS e_min, CAST(110000 - n_nationkey * 5760 AS DOUBLE) AS e_max, CAST(r_regionkey * 5760 AS DOUBLE) AS n_min, CAST((r_regionkey + 1) * 5760 AS DOUBLE) AS n_max FROM nation, region")
def q_cell_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c")).crossJoin(F.broadcast(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("r"))))  # 25 by 5 cells of a fixed grid
    return cells.select("c", "r", *[v.alias(k) for k, v in geo.GridSpec(110000.0, 0.0, 5760.0, 25, 5).bounds_of(F.col("c"), F.col("r")).items()])


@query(f"""
WITH {RASTER_SQL}, s AS (SELECT a AS si, b AS sj, a * 29.0 / 11 AS y, b * 23.0 / 9 AS x FROM range(0, 12) q(a), range(0, 10) t(b)),
q AS (SELECT si, sj, least(floor(y) + a, 29) AS i, least(floor(x) + b, 23) AS j, (CASE a WHEN 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE b WHEN 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS w FROM s, (VALUES (0), (1)) p(a), (VALUES (0), (1)) t(b))
SELECT si, sj, round(sum(w * z), 4) AS z FROM q JOIN raster USING (i, j) GROUP BY si, sj
""")
def q_tls_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster at another size, corners on corners."""
    rows, cols = 12, 10
    s = spark.range(rows * cols).select(F.floor(F.col("id") / cols).alias("si"), (F.col("id") % cols).alias("sj"))
    s = s.withColumns({"y": F.col("si") * (DAYS - 1.0) / (rows - 1), "x": F.col("sj") * (HOURS - 1.0) / (cols - 1)})
    return bilinear(event_raster(spark, sf_dir), s, DAYS, HOURS).select("si", "sj", F.round("z", 4).alias("z"))


@query(f"""
WITH {POINTS_SQL}, n AS (SELECT a.vec_id, count(*) - 1 AS density FROM points a JOIN points b ON abs(a.x - b.x) <= 3 AND abs(a.y - b.y) <= 3 GROUP BY a.vec_id) SELECT vec_id, density FROM n
""")
def q_local_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geolith.operators.proximity import near_pairs

    p = vector_points(spark, sf_dir).select("vec_id", "x", "y")
    return near_pairs(p, p, 3.0).groupBy("vec_id").agg((F.count(F.lit(1)) - 1).alias("density"))


@query(f"""
WITH {RING_SQL} SELECT p_partkey, row_number() OVER (PARTITION BY CAST(w AS INT) % 5 ORDER BY w * h DESC, p_partkey) AS place, round(least(greatest(greatest(w, h) / 20, 0.5), 2), 6) AS scale, least(w, h) > 0 AND greatest(w, h) / least(w, h) >= 2.2 AS long FROM rings WHERE w > 0 AND h > 0
""")
def q_variant_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = part_rings(spark, sf_dir).filter("w > 0 AND h > 0")
    d = numbered(d.select("p_partkey", "w", "h", (F.col("w").cast("int") % 5).alias("kind")), ["kind"], F.floor(F.col("w") * F.col("h") / -10), [F.desc(F.col("w") * F.col("h")), "p_partkey"], "place")
    most, least = F.greatest("w", "h"), F.least("w", "h")
    return d.select("p_partkey", "place", F.round(F.least(F.greatest(most / 20, F.lit(0.5)), F.lit(2.0)), 6).alias("scale"), ((least > 0) & (most / least >= 2.2)).alias("long"))


@query(f"WITH {RING_SQL} SELECT p_partkey, round(w * h, 6) AS area, greatest(w, h) AS length FROM rings WHERE w > 0 AND h > 0")
def q_least_rectangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from geolith.functions.shapes import bounding_rectangle

    d = part_rings(spark, sf_dir).filter(rings.valid(F.col("ring"))).select("p_partkey", bounding_rectangle(F.col("ring")).alias("b"))
    return d.select("p_partkey", F.round("b.area", 6).alias("area"), F.round("b.length", 6).alias("length"))


@query("SELECT s_suppkey, CAST(CAST(s_acctbal AS FLOAT) AS DOUBLE) AS x, CAST(CAST(s_suppkey * 1.25 AS FLOAT) AS DOUBLE) AS y, s_name AS name FROM supplier")
def q_codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as fixed-width object records and back: 32-bit floats and names come through."""
    from geolith.sources.files import decoded_records, encoded_records

    s = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").cast("float").alias("x"), (F.col("s_suppkey") * 1.25).cast("float").alias("y"), F.lit(0.0).cast("float").alias("z"), F.lit(1.0).cast("float").alias("scale"), F.lit(0.0).cast("float").alias("heading"), F.col("s_name").alias("name"), "s_suppkey")
    files = encoded_records(s, "object").select(F.col("s_suppkey").cast("string").alias("path"), F.col("record").alias("content"))
    back = decoded_records(files, "object")
    return back.select(F.col("path").cast("long").alias("s_suppkey"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "name")


@query(f"""
WITH RECURSIVE {POINTS_SQL}, b AS (SELECT vec_id, x - 0.6 AS x0, x + 0.6 AS x1, y - 0.6 AS y0, y + 0.6 AS y1 FROM points),
e AS (SELECT a.vec_id AS u, o.vec_id AS v FROM b a JOIN b o ON a.vec_id <> o.vec_id AND a.x0 <= o.x1 AND o.x0 <= a.x1 AND a.y0 <= o.y1 AND o.y0 <= a.y1),
r AS (SELECT vec_id AS node, vec_id AS root FROM b UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node), l AS (SELECT node AS vec_id, min(root) AS label FROM r GROUP BY node)
SELECT label, count(*) AS n, round(min(x0), 6) AS x0, round(max(x1), 6) AS x1, round(min(y0), 6) AS y0, round(max(y1), 6) AS y1 FROM b JOIN l USING (vec_id) GROUP BY label
""")
def q_dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints that overlap, as one."""
    from geolith.operators.graph import dissolved

    x, y = F.col("x"), F.col("y")
    boxes = vector_points(spark, sf_dir).select("vec_id", (x - 0.6).alias("x0"), (x + 0.6).alias("x1"), (y - 0.6).alias("y0"), (y + 0.6).alias("y1"))
    d = dissolved(boxes, "vec_id", 1.2)
    return d.select("label", "n", *[F.round(c, 6).alias(c) for c in ("x0", "x1", "y0", "y1")])
