"""Queries on pixels and classes: legends, blank tiles, masks, largest parts, outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import geo
from geolith.operators import rasters as R
from geolith.operators.ranking import numbered, percentiles
from geolith.plans.registry import Registry
from geolith.plans.tables import POINTS_SQL, RASTER_SQL, event_raster, table, vector_points
from geolith.plans.vectors import PLACES_SQL, supplier_places

query = Registry()


@query(f"""
WITH {RASTER_SQL}, p AS (SELECT i, j, CASE WHEN z > 52 THEN 0 WHEN z > 46 THEN 128 ELSE 255 END AS r, CASE WHEN z > 52 THEN 128 ELSE 255 END AS g, CASE WHEN j % 5 = 0 THEN 1 ELSE 0 END AS b FROM raster),
l AS (SELECT * FROM (VALUES (0, 128, 0, 311), (128, 255, 0, 312), (255, 255, 0, 313)) v(r, g, b, code))
SELECT i, j, coalesce(code, 0) AS code FROM p LEFT JOIN l USING (r, g, b)
""")
def q_legend_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact colours to class codes; other colours are class 0."""
    z = F.col("z")
    p = event_raster(spark, sf_dir).select("i", "j", F.when(z > 52, 0).when(z > 46, 128).otherwise(255).alias("r"), F.when(z > 52, 128).otherwise(255).alias("g"), F.when(F.col("j") % 5 == 0, 1).otherwise(0).alias("b"))
    legend = spark.createDataFrame([(0, 128, 0, 311), (128, 255, 0, 312), (255, 255, 0, 313)], "r INT, g INT, b INT, code INT")
    return p.join(F.broadcast(legend), ["r", "g", "b"], "left").select("i", "j", F.coalesce("code", F.lit(0)).alias("code"))  # three rows


@query("""
SELECT user_id, round(avg(CAST(value > 120 AS INT)), 6) AS bright, round(stddev_pop(value), 5) AS spread FROM events GROUP BY user_id HAVING avg(CAST(value > 120 AS INT)) > 0.12 OR stddev_pop(value) < 40
""")
def q_blank_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that are mostly bright, or all alike."""
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(F.avg((F.col("value") > 120).cast("int")).alias("b"), F.stddev_pop("value").alias("s"))
    return d.filter("b > 0.12 OR s < 40").select("user_id", F.round("b", 6).alias("bright"), F.round("s", 5).alias("spread"))


@query(f"""
WITH {POINTS_SQL} SELECT vec_id, CASE WHEN x - 4 >= -20 AND x + 4 <= 20 AND y - 4 >= -20 AND y + 4 <= 20 THEN 'inside' WHEN x + 4 < -20 OR x - 4 > 20 OR y + 4 < -20 OR y - 4 > 20 THEN 'outside' ELSE 'straddles' END AS place FROM points
""")
def q_mask_fast_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a tile lies in the mask, beyond it, or has to be looked at cell by cell."""
    x, y = F.col("x"), F.col("y")
    within = (x - 4 >= -20) & (x + 4 <= 20) & (y - 4 >= -20) & (y + 4 <= 20)
    beyond = (x + 4 < -20) | (x - 4 > 20) | (y + 4 < -20) | (y - 4 > 20)
    return vector_points(spark, sf_dir).select("vec_id", F.when(within, "inside").when(beyond, "outside").otherwise("straddles").alias("place"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 2) AS area FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1
""")
def q_largest_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.max(F.struct("l_extendedprice", (-F.col("l_linenumber")).alias("a"), (-F.col("l_partkey")).alias("b"))).alias("m")
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best)
    return d.select("l_orderkey", (-F.col("m.a")).alias("l_linenumber"), (-F.col("m.b")).alias("l_partkey"), F.round("m.l_extendedprice", 2).alias("area"))


@query(f"""
WITH {POINTS_SQL}, a AS (SELECT src, vec_id, atan2(y, x) AS a FROM points) SELECT src, vec_id, CAST(row_number() OVER (PARTITION BY src ORDER BY a, vec_id) AS INT) AS place FROM a
""")
def q_angular_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vector_points(spark, sf_dir).withColumn("a", F.atan2("y", "x"))
    sector = F.floor(F.col("a") * (1024 / 3.141592653589793))
    return numbered(p.select("src", "vec_id", "a"), ["src"], sector, ["a", "vec_id"], "place").select("src", "vec_id", F.col("place").cast("int").alias("place"))


@query(f"""
WITH {RASTER_SQL}, m AS (SELECT i, j FROM raster WHERE z > 50), d AS (SELECT * FROM (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) v(a, b))
SELECT m.i, m.j, a, b FROM m, d WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.i = m.i + a AND o.j = m.j + b)
""")
def q_mask_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sides of a mask's cells that border on what is not in it: the outline, edge by edge."""
    m = event_raster(spark, sf_dir).filter("z > 50").select("i", "j")
    return R.outline(m)


@query(f"""
WITH {PLACES_SQL}, b AS (SELECT s_suppkey % 7 AS tile, lon, lat FROM places), c AS (SELECT tile, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM b GROUP BY tile),
k AS (SELECT tile, w + (e - w) * t / 4.0 AS lon, s AS lat FROM c, range(0, 5) r(t) UNION ALL SELECT tile, w + (e - w) * t / 4.0, n FROM c, range(0, 5) r(t) UNION ALL SELECT tile, w, s + (n - s) * t / 4.0 FROM c, range(0, 5) r(t) UNION ALL SELECT tile, e, s + (n - s) * t / 4.0 FROM c, range(0, 5) r(t))
SELECT tile, round(min(radians(lon) * 6378137), 3) AS x0, round(max(radians(lon) * 6378137), 3) AS x1, round(min(asinh(tan(radians(lat))) * 6378137), 3) AS y0, round(max(asinh(tan(radians(lat))) * 6378137), 3) AS y1 FROM k GROUP BY tile
""")
def q_projected_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box around a box's sides in another projection, from points along the sides."""
    c = supplier_places(spark, sf_dir).groupBy((F.col("s_suppkey") % 7).alias("tile")).agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    t = F.col("t") / 4.0
    lon, lat = F.col("w") + (F.col("e") - F.col("w")) * t, F.col("s") + (F.col("n") - F.col("s")) * t
    sides = F.array(F.struct(lon.alias("lon"), F.col("s").alias("lat")), F.struct(lon.alias("lon"), F.col("n").alias("lat")), F.struct(F.col("w").alias("lon"), lat.alias("lat")), F.struct(F.col("e").alias("lon"), lat.alias("lat")))
    k = c.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(4)))).select("tile", F.inline(sides))
    x, y = geo.web_mercator(F.col("lon"), F.col("lat"))
    return k.groupBy("tile").agg(F.round(F.min(x), 3).alias("x0"), F.round(F.max(x), 3).alias("x1"), F.round(F.min(y), 3).alias("y0"), F.round(F.max(y), 3).alias("y1"))


@query("""
WITH o AS (SELECT s_suppkey AS k, 'obj_' || CAST(s_suppkey AS VARCHAR) AS name FROM supplier), r AS (SELECT 'obj_' || CAST(p_partkey * 3 AS VARCHAR) AS name, p_size * 4.0 AS perimeter FROM part)
SELECT k, o.name, CAST(perimeter AS DOUBLE) AS perimeter FROM o JOIN r ON o.name = r.name
""")
def q_sidecar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the shapes of their names; records without one are dropped."""
    name = lambda c: F.concat(F.lit("obj_"), F.expr(c).cast("string")).alias("name")
    shapes = table(spark, sf_dir, "part").select(name("p_partkey * 3"), (F.col("p_size") * 4.0).alias("perimeter"))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), name("s_suppkey")).join(shapes, "name").select("k", "name", "perimeter")


@query("""
WITH c AS (SELECT o_custkey AS tile, count(*) AS n FROM orders GROUP BY 1) SELECT tile, least(n, 12) AS n, n >= 12 AS truncated FROM c
""")
def q_truncated_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers cut at a count, and so marked as truncated."""
    n = F.count(F.lit(1))
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("tile")).agg(F.least(n, F.lit(12)).alias("n"), (n >= 12).alias("truncated"))


@query(f"""
WITH {POINTS_SQL}, p AS (SELECT src, x, y, abs(x) + 0.1 AS w FROM points), r AS (SELECT src, median(x) AS mx, median(y) AS my, sum(w * x) / sum(w) AS wx, sum(w * y) / sum(w) AS wy, count(*) AS n FROM p GROUP BY src)
SELECT src, round(mx, 6) AS mx, round(my, 6) AS my, round(wx, 6) AS wx, round(wy, 6) AS wy, CASE WHEN sqrt(mx * mx + my * my) > 1.5 THEN 'move' ELSE 'keep' END AS anchor FROM r
""")
def q_alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and weighted mean of shifts of each source, and whether its anchor should move."""
    w = F.abs("x") + 0.1
    p = vector_points(spark, sf_dir)
    middle = lambda c: percentiles(p, "src", c, [0.5], 0.25).select("src", F.col("p")[0].alias(f"m{c}"))
    r = p.groupBy("src").agg((F.sum(w * F.col("x")) / F.sum(w)).alias("wx"), (F.sum(w * F.col("y")) / F.sum(w)).alias("wy"))
    r = r.join(middle("x"), "src").join(middle("y"), "src")
    anchor = F.when(F.hypot("mx", "my") > 1.5, "move").otherwise("keep")
    return r.select("src", *[F.round(c, 6).alias(c) for c in ("mx", "my", "wx", "wy")], anchor.alias("anchor"))


@query(f"""
WITH {PLACES_SQL}, c AS (SELECT s_suppkey AS k, (lon - 21) * 100 AS x, (lat - 41.5) * 100 AS y, heading FROM places), d AS (SELECT *, x * sin(radians(30)) + y * cos(radians(30)) AS along, x * cos(radians(30)) - y * sin(radians(30)) AS across FROM c)
SELECT k, round(along, 5) AS along, round(across, 5) AS across, abs(across) <= 60 AND abs(along) <= 150 AS on_runway, abs((((30 - heading + 90) % 180) + 180) % 180 - 90) <= 3 AS aligned FROM d
""")
def q_runway_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places within a corridor, and headings within three degrees of its axis."""
    p = supplier_places(spark, sf_dir)
    along, across = geo.rotate((F.col("lat") - 41.5) * 100, (F.col("lon") - 21) * 100, F.lit(30.0))
    return p.select(
        F.col("s_suppkey").alias("k"), F.round(along, 5).alias("along"), F.round(across, 5).alias("across"), ((F.abs(across) <= 60) & (F.abs(along) <= 150)).alias("on_runway"),
        (F.abs(geo.axis_difference(F.col("heading"), F.lit(30.0))) <= 3).alias("aligned"),
    )


@query("""
WITH b AS (SELECT p_partkey AS k, (p_partkey * 7919) % 65536 AS a, (p_partkey * 104729) % 65536 AS b, (p_partkey * 2654435761) % 4294967296 AS bits FROM part),
e AS (SELECT *, ((a >> 11) << 3) | (a >> 13) AS r0, (((a >> 5) & 63) << 2) | ((a >> 9) & 3) AS g0, ((a & 31) << 3) | ((a & 31) >> 2) AS b0, ((b >> 11) << 3) | (b >> 13) AS r1, (((b >> 5) & 63) << 2) | ((b >> 9) & 3) AS g1, ((b & 31) << 3) | ((b & 31) >> 2) AS b1 FROM b),
p AS (SELECT *, n // 4 AS i, n % 4 AS j, (bits >> (2 * n)) & 3 AS c, a > b AS four FROM e, range(16) t(n)),
m AS (SELECT k, i, j, c, four, CASE c WHEN 0 THEN 3 WHEN 1 THEN 0 WHEN 2 THEN CASE WHEN four THEN 2 ELSE -1 END ELSE CASE WHEN four THEN 1 ELSE -2 END END AS w, r0, g0, b0, r1, g1, b1 FROM p)
SELECT k, i::INT AS i, j::INT AS j, (CASE w WHEN -2 THEN 0 WHEN -1 THEN (r0 + r1) // 2 ELSE (w * r0 + (3 - w) * r1) // 3 END)::INT AS r, (CASE w WHEN -2 THEN 0 WHEN -1 THEN (g0 + g1) // 2 ELSE (w * g0 + (3 - w) * g1) // 3 END)::INT AS g,
  (CASE w WHEN -2 THEN 0 WHEN -1 THEN (b0 + b1) // 2 ELSE (w * b0 + (3 - w) * b1) // 3 END)::INT AS b, (CASE w WHEN -2 THEN 0 ELSE 255 END)::INT AS a FROM m
""")
def q_block_texture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of compressed blocks, whose colours and bits follow from the part."""
    from geolith.sources.textures import block_pixels

    k = F.col("p_partkey")
    little = lambda v, n: F.concat(*[F.lpad(F.hex(F.shiftright(v, 8 * b).bitwiseAND(F.lit(255))), 2, "0") for b in range(n)])
    block = F.unhex(F.concat(little(k * 7919 % 65536, 2), little(k * 104729 % 65536, 2), little(k * 2654435761 % 4294967296, 4)))
    return block_pixels(table(spark, sf_dir, "part").select(k.alias("k"), block.alias("block")), "block")
