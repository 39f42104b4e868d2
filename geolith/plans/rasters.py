"""Raster queries on the event raster: neighbours, gradients, resampling, morphology, seams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.functions import rings
from geolith.functions.colour import blend
from geolith.functions.geo import ramp, smoothstep
from geolith.operators import rasters as R
from geolith.plans.registry import Registry
from geolith.plans.tables import DAYS, HOURS, POINTS_SQL, RASTER_SQL, event_raster, vector_points

query = Registry()

GRADIENT_SQL = f"""{RASTER_SQL}, n AS (SELECT o.i, o.j, o.z, l.z AS l, rr.z AS rr, u.z AS u, d.z AS d FROM raster o LEFT JOIN raster l ON l.i = o.i AND l.j = o.j - 1
  LEFT JOIN raster rr ON rr.i = o.i AND rr.j = o.j + 1 LEFT JOIN raster u ON u.i = o.i - 1 AND u.j = o.j LEFT JOIN raster d ON d.i = o.i + 1 AND d.j = o.j),
g AS (SELECT i, j, z, coalesce((rr - l) / 2, rr - z, z - l, 0) AS gx, coalesce((d - u) / 2, d - z, z - u, 0) AS gy FROM n)"""


@query(f"WITH {RASTER_SQL} SELECT a.i, a.j, round(abs(a.z - b.z), 6) AS step FROM raster a JOIN raster b ON b.i = a.i + 1 AND b.j = a.j WHERE a.i % 6 = 5")
def q_neighbour_seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    after = r.select((F.col("i") - 1).alias("i"), "j", F.col("z").alias("next"))
    return r.filter("i % 6 = 5").join(after, ["i", "j"]).select("i", "j", F.round(F.abs(F.col("z") - F.col("next")), 6).alias("step"))


@query(f"""
WITH {RASTER_SQL} SELECT a.i, a.j, count(*) AS n, round(quantile_cont(b.z, 0.5), 6) AS middle
FROM raster a JOIN raster b ON abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 AND NOT (a.i = b.i AND a.j = b.j) WHERE b.z < 80 GROUP BY 1, 2
""")
def q_neighbour8_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    around = R.shifted(r.filter("z < 80"), R.AROUND).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.round(F.median("z"), 6).alias("middle"))
    return around.join(r.select("i", "j"), ["i", "j"], "left_semi")


@query(f"WITH {RASTER_SQL} SELECT CAST(floor(i / 3) AS BIGINT) AS i, CAST(floor(j / 3) AS BIGINT) AS j, round(avg(z), 5) AS z FROM raster GROUP BY 1, 2")
def q_avg_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pooled(event_raster(spark, sf_dir), 3).withColumn("z", F.round("z", 5))


@query(f"WITH {GRADIENT_SQL} SELECT i, j, round(gx, 6) AS gx, round(gy, 6) AS gy, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope, round(((degrees(atan2(-gx, gy)) % 360) + 360) % 360, 5) AS aspect FROM g")
def q_gradient_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    gx, gy = F.col("gx"), F.col("gy")
    return R.gradient(event_raster(spark, sf_dir)).select("i", "j", F.round(gx, 6).alias("gx"), F.round(gy, 6).alias("gy"), F.round(R.slope_degrees(gx, gy), 6).alias("slope"), F.round(R.aspect_degrees(gx, gy), 5).alias("aspect"))


@query(f"""
WITH {GRADIENT_SQL}, s AS (SELECT *, atan(sqrt(gx * gx + gy * gy)) AS sl, atan2(gy, -gx) AS asp FROM g)
SELECT i, j, round(greatest(sin(radians(45)) * cos(sl) + cos(radians(45)) * sin(sl) * cos(radians(135) - asp), 0), 6) AS shade FROM s
""")
def q_hillshade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.gradient(event_raster(spark, sf_dir)).select("i", "j", F.round(R.hillshade(F.col("gx"), F.col("gy"), 315.0, 45.0), 6).alias("shade"))


@query(f"""
WITH {GRADIENT_SQL}, s AS (SELECT *, degrees(atan(sqrt(gx * gx + gy * gy))) AS sl FROM g), m AS (SELECT min(z) AS lo, max(z) AS hi, max(sl) AS top FROM s),
t AS (SELECT i, j, (0.6 * (z - lo) / nullif(hi - lo, 0) + 0.4 * (1 - sl / nullif(top, 0))) * CASE WHEN z < 50 AND sl < 60 THEN 0.5 ELSE 1 END AS v FROM s, m)
SELECT i, j, CAST(trunc(round(v * 255, 6)) AS INT) AS thermal FROM t
""")
def q_thermal_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = R.gradient(event_raster(spark, sf_dir)).withColumn("sl", R.slope_degrees(F.col("gx"), F.col("gy")))
    m = s.agg(F.min("z").alias("lo"), F.max("z").alias("hi"), F.max("sl").alias("top"))
    height, flat = (F.col("z") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)), F.lit(1.0) - F.col("sl") / F.nullif(F.col("top"), F.lit(0.0))
    v = (height * 0.6 + flat * 0.4) * F.when((F.col("z") < 50) & (F.col("sl") < 60), 0.5).otherwise(1.0)
    return s.crossJoin(F.broadcast(m)).select("i", "j", F.round(v * 255, 6).cast("int").alias("thermal"))  # m is one row


@query(f"""
WITH {RASTER_SQL}, s AS (SELECT i AS si, j AS sj, i + 0.2137 AS y, j * 1.0371 - 0.4 AS x FROM raster), c AS (SELECT si, sj, least(greatest(y, 0), 29) AS y, least(greatest(x, 0), 23) AS x FROM s),
q AS (SELECT si, sj, least(floor(y) + a, 29) AS i, least(floor(x) + b, 23) AS j, (CASE a WHEN 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE b WHEN 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS w FROM c, (VALUES (0), (1)) p(a), (VALUES (0), (1)) t(b))
SELECT si, sj, round(sum(w * z), 8) AS z FROM q JOIN raster USING (i, j) GROUP BY si, sj
""")
def q_bilinear_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    s = r.select(F.col("i").alias("si"), F.col("j").alias("sj"), (F.col("i") + 0.2137).alias("y"), (F.col("j") * 1.0371 - 0.4).alias("x"))
    return R.bilinear(r, s, DAYS, HOURS).select("si", "sj", F.round("z", 8).alias("z"))


OPENING_SQL = f"""{RASTER_SQL}, m AS (SELECT i, j FROM raster WHERE z > 38), x AS (SELECT * FROM (VALUES (0,0),(1,0),(-1,0),(0,1),(0,-1)) v(a, b)),
e AS (SELECT i - a AS i, j - b AS j FROM m, x GROUP BY 1, 2 HAVING count(*) = 5), o AS (SELECT DISTINCT i - a AS i, j - b AS j FROM e, x)"""


@query(f"WITH {OPENING_SQL} SELECT i, j FROM o WHERE i BETWEEN 0 AND 29 AND j BETWEEN 0 AND 23")
def q_binary_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.opened(event_raster(spark, sf_dir).filter("z > 38").select("i", "j"), DAYS, HOURS)


@query(f"""
WITH RECURSIVE {RASTER_SQL}, m AS (SELECT i, j, i * 24 + j AS k FROM raster WHERE z > 55), w AS (SELECT k AS root, k FROM m UNION SELECT w.root, b.k FROM w JOIN m a ON a.k = w.k JOIN m b ON abs(a.i - b.i) + abs(a.j - b.j) = 1)
SELECT m.i, m.j, l.label::BIGINT AS label, count(*) OVER (PARTITION BY l.label) AS size FROM m JOIN (SELECT k, min(root) AS label FROM w GROUP BY k) l USING (k)
""")
def q_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = R.labelled(event_raster(spark, sf_dir).filter("z > 55"), HOURS)
    return d.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("label")))


@query(f"WITH {RASTER_SQL} SELECT 23 - j AS i, 23 - i AS j, z FROM raster WHERE i < 24")
def q_antitranspose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.anti_transposed(event_raster(spark, sf_dir).filter(f"i < {HOURS}"), HOURS)


@query(f"""
WITH {RASTER_SQL}, p AS (SELECT i, j, z, z + 3 * (j % 4) AS top, j * 10 AS alpha FROM raster)
SELECT i, j, round(CASE WHEN alpha < 128 THEN z * 0.45 + 200 * 0.55 ELSE z END, 6) AS tinted, round(CASE WHEN i % 5 = 0 THEN z ELSE top * least(greatest((j - 2.0) / 10, 0), 1) + z * (1 - least(greatest((j - 2.0) / 10, 0), 1)) END, 6) AS mixed,
       round(avg(CAST(alpha = 0 AS INT)) OVER (PARTITION BY i), 6) AS water FROM p
""")
def q_masked_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = event_raster(spark, sf_dir).withColumns({"top": F.col("z") + (F.col("j") % 4) * 3, "alpha": F.col("j") * 10})
    tinted = F.when(F.col("alpha") < 128, blend(F.col("z"), F.lit(200.0), F.lit(0.55))).otherwise(F.col("z"))
    mixed = F.when(F.col("i") % 5 == 0, F.col("z")).otherwise(blend(F.col("z"), F.col("top"), ramp(F.col("j").cast("double"), 2.0, 12.0)))
    water = F.avg((F.col("alpha") == 0).cast("int")).over(Window.partitionBy("i"))
    return p.select("i", "j", F.round(tinted, 6).alias("tinted"), F.round(mixed, 6).alias("mixed"), F.round(water, 6).alias("water"))


@query(f"""
WITH {RASTER_SQL}, d AS (SELECT i, j, z, greatest(abs((j - 12.0) * sin(radians(30)) + (i - 15.0) * cos(radians(30))) - 6, abs((j - 12.0) * cos(radians(30)) - (i - 15.0) * sin(radians(30))) - 2.5) AS d FROM raster),
b AS (SELECT *, least(greatest(d / 3, 0), 1) AS t FROM d)
SELECT i, j, round(CASE WHEN d <= 0 THEN 40 WHEN d < 3 THEN z * (t * t * (3 - 2 * t)) + 40 * (1 - t * t * (3 - 2 * t)) ELSE z END, 5) AS z, d < 3 AS changed FROM b
""")
def q_flatten_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    of = F.lit
    d = rings.distance_to_rectangle(F.col("j").cast("double"), F.col("i").cast("double"), of(12.0), of(15.0), of(30.0), of(12.0), of(5.0))
    r = r.withColumn("d", d)
    z = F.when(F.col("d") <= 0, 40.0).when(F.col("d") < 3, blend(F.lit(40.0), F.col("z"), smoothstep(F.col("d"), 0.0, 3.0))).otherwise(F.col("z"))
    return r.select("i", "j", F.round(z, 5).alias("z"), (F.col("d") < 3).alias("changed"))


@query(f"""
WITH {RASTER_SQL}, {POINTS_SQL}, s AS (SELECT vec_id, least(greatest(CAST(trunc((x + 40) / 80 * 24) AS INT), 0), 23) AS j, least(greatest(CAST(trunc((40 - y) / 80 * 30) AS INT), 0), 29) AS i FROM points)
SELECT vec_id, i, j, z FROM s JOIN raster USING (i, j)
""")
def q_lonlat_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = lambda share, n: F.least(F.greatest((share * n).cast("int"), F.lit(0)), F.lit(n - 1))
    s = vector_points(spark, sf_dir).select("vec_id", place((F.col("x") + 40) / 80, HOURS).alias("j"), place((F.lit(40) - F.col("y")) / 80, DAYS).alias("i"))
    return s.join(event_raster(spark, sf_dir), ["i", "j"]).select("vec_id", "i", "j", "z")


@query(f"""
WITH {RASTER_SQL}, e AS (SELECT CAST(i // 6 AS INT) AS pair, j, i, z FROM raster WHERE i % 6 = 5 OR i % 6 = 0), s AS (SELECT a.pair, abs(a.z - b.z) AS d FROM e a JOIN e b ON a.j = b.j AND b.i = a.i + 1)
SELECT pair, count(*) AS n, round(max(d), 6) AS worst, round(avg(d), 8) AS mean, bool_and(d < 60) AS passed FROM s GROUP BY pair
""")
def q_seam_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    low = r.filter("i % 6 = 5").select(F.floor(F.col("i") / 6).cast("int").alias("pair"), "j", (F.col("i") + 1).alias("i"), F.col("z").alias("a"))
    d = low.join(r.filter("i % 6 = 0"), ["i", "j"]).select("pair", F.abs(F.col("a") - F.col("z")).alias("d"))
    return d.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("d"), 6).alias("worst"), F.round(F.avg("d"), 8).alias("mean"), F.bool_and(F.col("d") < 60).alias("passed"))


@query(f"""
WITH {RASTER_SQL}, {POINTS_SQL}, w AS (SELECT vec_id, round(avg(z), 8) AS colour, count(z) AS n FROM points LEFT JOIN raster ON abs(j - (x + 40) / 80 * 24) <= 1.5 AND abs(i - (y + 40) / 80 * 30) <= 1.5 AND z > 30 GROUP BY vec_id)
SELECT vec_id, coalesce(colour, 0.6) AS colour, n FROM w
""")
def q_window_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vector_points(spark, sf_dir).select("vec_id", ((F.col("x") + 40) / 80 * HOURS).alias("px"), ((F.col("y") + 40) / 80 * DAYS).alias("py"))
    span = lambda c: F.explode(F.sequence(F.ceil(F.col(c) - 1.5), F.floor(F.col(c) + 1.5)))
    cells = p.withColumn("j", span("px")).withColumn("i", span("py")).select("vec_id", "i", "j")
    r = event_raster(spark, sf_dir).filter("z > 30").select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "z")
    w = cells.join(r, ["i", "j"]).groupBy("vec_id").agg(F.round(F.avg("z"), 8).alias("colour"), F.count("z").alias("n"))
    return p.select("vec_id").join(w, "vec_id", "left").select("vec_id", F.coalesce("colour", F.lit(0.6)).alias("colour"), F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""
WITH {GRADIENT_SQL}, t AS (SELECT i, j, z, ((degrees(atan2(-gx, gy)) % 360) + 360) % 360 AS asp, z > 45 OR (z > 38 AND j % 3 = 0) AS forest FROM g),
p AS (SELECT *, least(greatest((z - 30) / 40, 0), 1) * 0.7 + 0.3 * (1 + cos(radians(asp))) / 2 AS prob FROM t)
SELECT i, j, CASE WHEN NOT forest OR z > 90 THEN 0 WHEN prob >= 0.5 THEN 1 ELSE 2 END AS species, round(prob, 8) AS prob FROM p
""")
def q_species_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = R.gradient(event_raster(spark, sf_dir)).withColumn("asp", R.aspect_degrees(F.col("gx"), F.col("gy")))
    forest = (F.col("z") > 45) | ((F.col("z") > 38) & (F.col("j") % 3 == 0))
    t = t.withColumn("prob", ramp(F.col("z"), 30.0, 70.0) * 0.7 + (F.cos(F.radians("asp")) + 1) * 0.15)
    return t.select("i", "j", F.when(~forest | (F.col("z") > 90), 0).when(F.col("prob") >= 0.5, 1).otherwise(2).alias("species"), F.round("prob", 8).alias("prob"))


@query(f"""
WITH {RASTER_SQL}, {POINTS_SQL}, p AS (SELECT vec_id, x, y, abs(x * y) AS area FROM points), r AS (SELECT vec_id, area, x, y, CASE WHEN x NOT BETWEEN -30 AND 30 OR y NOT BETWEEN -30 AND 30 THEN 'outside' WHEN area < 20 THEN 'small' ELSE 'kept' END AS reason FROM p)
SELECT vec_id, round(area, 6) AS area, CAST(floor((30 - x) / 6) AS BIGINT) AS c, CAST(floor((y + 30) / 6) AS BIGINT) AS r, z AS altitude
FROM r JOIN raster ON j = least(greatest(CAST(round_even((x + 40) / 80 * 23, 0) AS INT), 0), 23) AND i = least(greatest(CAST(round_even((y + 40) / 80 * 29, 0) AS INT), 0), 29)
WHERE reason = 'kept' ORDER BY area DESC, vec_id LIMIT 60
""")
def q_place_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    p = vector_points(spark, sf_dir).withColumn("area", F.abs(x * y))
    kept = p.filter(x.between(-30, 30) & y.between(-30, 30) & (F.col("area") >= 20))
    near = lambda share, n: F.least(F.greatest(F.rint(share * (n - 1)).cast("int"), F.lit(0)), F.lit(n - 1))
    placed = kept.withColumns({"j": near((x + 40) / 80, HOURS), "i": near((y + 40) / 80, DAYS)}).join(event_raster(spark, sf_dir), ["i", "j"])
    top = placed.orderBy(F.desc("area"), "vec_id").limit(60)  # the feature: the largest first, up to a number
    return top.select("vec_id", F.round("area", 6).alias("area"), F.floor((F.lit(30) - x) / 6).alias("c"), F.floor((y + 30) / 6).alias("r"), F.col("z").alias("altitude"))


@query(f"""
WITH {RASTER_SQL}, b AS (SELECT DISTINCT r.i // 6 AS p, r.j // 8 AS q, i, j, z FROM raster r), s AS (SELECT i, j, z, a AS p, b AS q FROM raster, range(0, 5) t(a), range(0, 3) u(b) WHERE i BETWEEN a * 6 AND a * 6 + 6 AND j BETWEEN b * 8 AND b * 8 + 8)
SELECT CAST(p AS INT) AS p, CAST(q AS INT) AS q, count(*) AS n, round(sum(z), 4) AS total FROM s GROUP BY 1, 2
""")
def q_shared_edge_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda c, size, n: F.explode(F.filter(F.array_distinct(F.array(F.floor(F.col(c) / size), F.floor((F.col(c) - 1) / size))), lambda x: x.between(0, n - 1)))
    s = event_raster(spark, sf_dir).withColumn("p", of("i", 6, 5)).withColumn("q", of("j", 8, 3))
    return s.groupBy(F.col("p").cast("int").alias("p"), F.col("q").cast("int").alias("q")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 4).alias("total"))


@query(f"""
WITH {RASTER_SQL}, m AS (SELECT i, j FROM raster WHERE z > 56) SELECT r.i, r.j, min((r.i - m.i) * (r.i - m.i) + (r.j - m.j) * (r.j - m.j))::BIGINT AS d2 FROM raster r, m GROUP BY r.i, r.j
""")
def q_distance_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    return R.distances(r.filter("z > 56"), DAYS, HOURS).join(r.select("i", "j"), ["i", "j"]).select("i", "j", F.col("d2").cast("long").alias("d2"))


@query(f"""
WITH {RASTER_SQL}, o AS (SELECT i + 1 AS i, j - 2 AS j, z + 0.5 AS z FROM raster), s AS (SELECT di, dj, round(avg(abs(r.z - o.z)), 6) AS score FROM range(-2, 3) a(di), range(-2, 3) b(dj), raster r JOIN o ON r.i = o.i + di AND r.j = o.j + dj GROUP BY di, dj)
SELECT CAST(di AS INT) AS di, CAST(dj AS INT) AS dj, score FROM s ORDER BY score, di, dj LIMIT 1
""")
def q_best_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_raster(spark, sf_dir)
    return R.best_shift(r, r.select((F.col("i") + 1).alias("i"), (F.col("j") - 2).alias("j"), (F.col("z") + 0.5).alias("z")), 2)
