"""Records and files beside the maps: placements, nested airports, reference systems, mosaics, sidecars, folders, styles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import datum, geo, rings
from geolith.functions.colour import clamped_shift
from geolith.operators.proximity import cells_of_box
from geolith.plans.features import _PARTS_SQL, LINES_SQL, _lines
from geolith.plans.registry import Registry
from geolith.plans.tables import POINTS_SQL, RASTER_SQL, event_raster, table
from geolith.plans.vectors import PLACES_SQL, _utm, _utm_sql, supplier_places
from geolith.sources import text

query = Registry()

#: South-east corner that placements count from.
ANCHOR_E, ANCHOR_N = 700000.0, 4400000.0


@query(f"WITH {_utm_sql()}, r AS (SELECT *, radians(heading - 400) AS a, 2 * pi() AS turn FROM utm) SELECT s_suppkey, round({ANCHOR_E} - e, 4) AS pos_x, round(n - {ANCHOR_N}, 4) AS pos_y, round(a - turn * floor(a / turn), 6) AS ori, round(e, 3) AS e, round(n, 3) AS n FROM r")
def q_placement_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placements west and north of a corner, their turn folded to one circle, and the places that they stand for."""
    placed = _utm(spark, sf_dir).select("s_suppkey", (F.lit(ANCHOR_E) - F.col("e")).alias("px"), (F.col("n") - ANCHOR_N).alias("py"), geo.orientation(F.col("heading") - 400).alias("ori"))
    return placed.select("s_suppkey", F.round("px", 4).alias("pos_x"), F.round("py", 4).alias("pos_y"), F.round("ori", 6).alias("ori"), F.round(F.lit(ANCHOR_E) - F.col("px"), 3).alias("e"), F.round(F.col("py") + ANCHOR_N, 3).alias("n"))


def _datum_sql() -> str:
    """Places shifted to the other datum and projected there, step by step."""
    t, a, f = datum.BALKANS_SHIFT, datum.BESSEL_AXIS, datum.BESSEL_FLATTENING
    e2, b2 = geo.FLATTENING * (2 - geo.FLATTENING), f * (2 - f)
    radius, ecc, alpha = geo.third_flattening(a, f)
    north = " + ".join(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(alpha, 1))
    east = " + ".join(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(alpha, 1))
    near = lambda beta: f"atan2(z + {b2 / (1 - b2) * a * (1 - f)!r} * pow(sin({beta}), 3), sqrt(x * x + y * y) - {b2 * a!r} * pow(cos({beta}), 3))"
    return f"""{PLACES_SQL}, g AS (SELECT s_suppkey, lon AS lon0, lat AS lat0, radians(lat) AS p, radians(lon) AS l, {geo.AXIS!r} / sqrt(1 - {e2!r} * sin(radians(lat)) * sin(radians(lat))) AS n FROM places),
c AS (SELECT s_suppkey, lon0, lat0, n * cos(p) * cos(l) - ({t.x}) AS x, n * cos(p) * sin(l) - ({t.y}) AS y, n * {1 - e2!r} * sin(p) - ({t.z}) AS z FROM g),
q AS (SELECT *, {near(f"atan2(z, sqrt(x * x + y * y) * {1 - f!r})")} AS phi1 FROM c), r AS (SELECT *, {near(f"atan2({1 - f!r} * sin(phi1), cos(phi1))")} AS phi, atan2(y, x) - radians(21) AS lam FROM q),
s AS (SELECT *, sinh(atanh(sin(phi)) - {ecc!r} * atanh({ecc!r} * sin(phi))) AS t FROM r), w AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM s),
shifted AS (SELECT s_suppkey, lon0, lat0, 7500000 + {datum.BALKANS_7.scale * radius!r} * (eta + {east}) AS e, {datum.BALKANS_7.scale * radius!r} * (xi + {north}) AS n FROM w)"""


@query(f"WITH {_datum_sql()} SELECT s_suppkey, round(e, 4) AS e, round(n, 4) AS n, round(lon0, 7) AS lon, round(lat0, 7) AS lat FROM shifted")
def q_datum_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in the coordinates of another datum and projection, and the places again from these."""
    there = datum.to_balkans_7(supplier_places(spark, sf_dir).select("s_suppkey", "lon", "lat", F.lit(0.0).alias("h")), "lon", "lat", "e", "n", "h").select("s_suppkey", "e", "n", "h")
    back = datum.balkans_7(there, "e", "n", "lon", "lat", "h")
    return back.select("s_suppkey", F.round("e", 4).alias("e"), F.round("n", 4).alias("n"), F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


def _laea_sql() -> str:
    t = geo.laea_terms()
    q = f"(1 - {t.ecc**2!r}) * (s / (1 - {t.ecc**2!r} * s * s) - ln((1 - {t.ecc!r} * s) / (1 + {t.ecc!r} * s)) / (2 * {t.ecc!r}))"
    return f"""{PLACES_SQL}, s AS (SELECT *, sin(radians(lat)) AS s, radians(lon - {geo.LAEA_LON}) AS lam FROM places), b AS (SELECT *, asin({q} / {t.q_pole!r}) AS beta FROM s),
d AS (SELECT *, {t.radius!r} * sqrt(2 / (1 + {t.sin_centre!r} * sin(beta) + {t.cos_centre!r} * cos(beta) * cos(lam))) AS d FROM b),
laea AS (SELECT *, {geo.LAEA_EAST} + d * {t.stretch!r} * cos(beta) * sin(lam) AS e, {geo.LAEA_NORTH} + d / {t.stretch!r} * ({t.cos_centre!r} * sin(beta) - {t.sin_centre!r} * cos(beta) * cos(lam)) AS n FROM d)"""


@query(f"WITH {_laea_sql()} SELECT s_suppkey, round(e, 4) AS e, round(n, 4) AS n, round(lon, 5) AS lon, round(lat, 5) AS lat FROM laea")
def q_laea(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal-area coordinates, and the places again from these."""
    e, n = geo.laea_forward(F.col("lon"), F.col("lat"))
    there = supplier_places(spark, sf_dir).select("s_suppkey", e.alias("e"), n.alias("n"))
    lon, lat = geo.laea_inverse(F.col("e"), F.col("n"))
    return there.select("s_suppkey", F.round("e", 4).alias("e"), F.round("n", 4).alias("n"), F.round(lon, 5).alias("lon"), F.round(lat, 5).alias("lat"))


@query("""
WITH s AS (SELECT s_suppkey, ((s_suppkey * 53) % 360)::DOUBLE AS heading FROM supplier)
SELECT s_suppkey AS airport, k AS runway, k = 0 AND s_suppkey % 3 = 0 AS aligned, CASE WHEN k = 0 AND s_suppkey % 3 = 0 THEN (heading + s_suppkey % 11 - 5 + 360) % 360 ELSE (heading + 60 * k) % 360 END AS heading FROM s, (VALUES (0), (1)) v(k)
""")
def q_nested_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first runway of each airport that was found in imagery takes the found axis, in the direction that it had; the others stay."""
    h, key = F.col("heading"), F.col("s_suppkey")
    found = F.pmod(h + key % 11 - 5 + F.when(key % 2 == 1, 180).otherwise(0), F.lit(360.0))
    runways = F.array(F.struct(h.alias("heading")), F.struct(F.pmod(h + 60, F.lit(360.0)).alias("heading")))
    airports = supplier_places(spark, sf_dir).select(key.alias("airport"), F.struct(runways.alias("runways")).alias("record"), F.when(key % 3 == 0, found).alias("axis"))

    def moved(runway: Column, k: Column) -> Column:
        aligned = (k == 0) & F.col("axis").isNotNull()
        heading = F.when(aligned, geo.nearer_direction(runway["heading"], F.col("axis"))).otherwise(runway["heading"])
        return runway.withField("heading", heading).withField("aligned", aligned)

    after = airports.withColumn("record", F.col("record").withField("runways", F.transform("record.runways", moved)))
    return after.select("airport", F.posexplode("record.runways").alias("runway", "r")).select("airport", "runway", "r.aligned", "r.heading")


@query("""
WITH f AS (SELECT p_partkey % 50 AS collection, p_partkey AS place, CASE WHEN p_partkey % 50 % 7 = 0 THEN 'urn:ogc:def:crs:EPSG::32634' END AS crs,
  CASE WHEN p_partkey % 4 = 0 OR p_partkey % 50 = 11 THEN NULL WHEN p_partkey % 50 % 3 = 0 THEN p_partkey % 180 ELSE 500000 + p_partkey END AS x, CASE WHEN p_partkey % 50 % 3 = 0 THEN p_partkey % 90 ELSE 4600000 + p_partkey END AS y FROM part),
g AS (SELECT collection, count(crs) > 0 AS tagged, arg_min(x, place) FILTER (WHERE x IS NOT NULL) AS x, arg_min(y, place) FILTER (WHERE x IS NOT NULL) AS y FROM f GROUP BY collection)
SELECT collection, tagged OR x IS NULL OR abs(x) > 180 OR abs(y) > 90 AS metres FROM g
""")
def q_crs_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    c = key % 50
    x = F.when((key % 4 != 0) & (c != 11), F.when(c % 3 == 0, key % 180).otherwise(key + 500000))
    y = F.when(c % 3 == 0, key % 90).otherwise(key + 4600000)
    return text.in_metres(table(spark, sf_dir, "part").select(c.alias("collection"), key.alias("place"), F.when(c % 7 == 0, "urn:ogc:def:crs:EPSG::32634").alias("crs"), x.alias("x"), y.alias("y")))


@query("""
WITH t AS (SELECT 'ortho&' || p_partkey || '.jpg' AS path, p_partkey % 40 + 5 AS x, p_partkey // 40 + 3 AS y FROM part), s AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM t), b AS (SELECT unnest([1, 2, 3])::INT AS band)
SELECT 0 AS band, 0 AS place, NULL::BIGINT AS y, NULL::BIGINT AS x, printf('<VRTDataset rasterXSize="%d" rasterYSize="%d"><SRS>EPSG:6316</SRS><GeoTransform>%.6f, 0.280000, 0, %.6f, 0, -0.280000</GeoTransform>', (x1 - x0 + 1) * 256, (y1 - y0 + 1) * 256, (7400000 + x0 * 71.68::DOUBLE)::DOUBLE, (4500000 + (y1 + 1) * 71.68::DOUBLE)::DOUBLE) AS value FROM s
UNION ALL SELECT band, 1, NULL, NULL, '<VRTRasterBand dataType="Byte" band="' || band || '">' FROM b
UNION ALL SELECT band, 2, y, x, '<SimpleSource><SourceFilename relativeToVRT="0">' || replace(path, '&', '&amp;') || '</SourceFilename><SourceBand>' || band || '</SourceBand><SrcRect xOff="0" yOff="0" xSize="256" ySize="256"/><DstRect xOff="' || (x - x0) * 256 || '" yOff="' || (y1 - y) * 256 || '" xSize="256" ySize="256"/></SimpleSource>' FROM t, s, b
UNION ALL SELECT band, 3, NULL, NULL, '</VRTRasterBand>' FROM b UNION ALL SELECT 4, 0, NULL, NULL, '</VRTDataset>'
""")
def q_mosaic_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    tiles = table(spark, sf_dir, "part").select(F.concat(F.lit("ortho&"), key.cast("string"), F.lit(".jpg")).alias("path"), (key % 40 + 5).alias("x"), (F.floor(key / 40) + 3).alias("y"))
    return text.mosaic_lines(tiles, 256, 0.28, 7400000.0, 4500000.0, "EPSG:6316")


@query("SELECT CAST(to_json({'size': p_size, 'placed': count(*) FILTER (WHERE p_partkey % 5 > 0), 'rejected': count(*) FILTER (WHERE p_partkey % 5 = 0), 'first': min(p_partkey), 'last': max(p_partkey)}) AS VARCHAR) AS value FROM part GROUP BY p_size")
def q_stats_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    stats = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("size")).agg(F.count_if(key % 5 > 0).alias("placed"), F.count_if(key % 5 == 0).alias("rejected"), F.min(key).alias("first"), F.max(key).alias("last"))
    return text.sidecar_lines(stats)


@query("SELECT 'x' || (l_partkey * 7 // 256) || '/y' || (l_suppkey * 11 // 256) AS folder, count(*) AS tiles, count(DISTINCT (l_partkey, l_suppkey)) AS names FROM lineitem GROUP BY 1")
def q_tile_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles by the folder that they move to."""
    t = table(spark, sf_dir, "lineitem").select(text.tile_folder(F.col("l_partkey") * 7, F.col("l_suppkey") * 11).alias("folder"), "l_partkey", "l_suppkey")
    named = t.groupBy("folder", "l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return named.groupBy("folder").agg(F.sum("n").alias("tiles"), F.count(F.lit(1)).alias("names"))


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS clock, count(*) AS n FROM events GROUP BY 1")
def q_clock_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("clock")).agg(F.count(F.lit(1)).alias("n"))


#: Most that a channel moves, and how far the second may lie above its target and still count as right.
CLAMPS, SLACK = (5.0, 3.0, 3.0), 1.0


def _channels_sql() -> str:
    channels = ", ".join(f"CAST(embedding[{k + 1}] AS DOUBLE) * 100 AS c{k}" for k in range(3))
    stats = ", ".join(f"avg(c{k}) AS m{k}, stddev_pop(c{k}) AS s{k}" for k in range(3))
    shift = [f"least(greatest((c{k} - q.m{k}) / (CASE WHEN q.s{k} < 1e-3 THEN 1 ELSE q.s{k} END) * t.s{k} + t.m{k} - c{k}, -{c}), {c})" for k, c in enumerate(CLAMPS)]
    shift[1] = f"CASE WHEN c1 <= t.m1 + {SLACK} THEN least({shift[1]}, 0) ELSE {shift[1]} END"
    return f"WITH p AS (SELECT vec_id, label % 3 AS src, {channels} FROM embeddings), q AS (SELECT src, {stats} FROM p GROUP BY src) SELECT vec_id, {', '.join(f'round(c{k} + {s}, 5) AS c{k}' for k, s in enumerate(shift))} FROM p JOIN q USING (src) JOIN q t ON t.src = 0"


@query(_channels_sql())
def q_clamped_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three channels nudged towards the mean and spread of source 0; the second only down where it is right already."""
    e = F.col("embedding")
    p = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") % 3).alias("src"), *[(e[k].cast("double") * 100).alias(f"c{k}") for k in range(3)])
    stats = p.groupBy("src").agg(*[f(f"c{k}").alias(f"{n}{k}") for k in range(3) for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    to = stats.filter("src = 0").select(*[F.col(f"{n}{k}").alias(f"t{n}{k}") for k in range(3) for n in "ms"])  # one row
    shift = [clamped_shift(*[F.col(f"{n}{k}") for n in ("c", "m", "s", "tm", "ts")], most) for k, most in enumerate(CLAMPS)]
    shift[1] = F.when(F.col("c1") <= F.col("tm1") + SLACK, F.least(shift[1], F.lit(0.0))).otherwise(shift[1])
    return p.join(stats.join(to), "src").select("vec_id", *[F.round(F.col(f"c{k}") + s, 5).alias(f"c{k}") for k, s in enumerate(shift)])


@query(f"WITH {RASTER_SQL} SELECT i, j, CASE WHEN (i + j) % 7 = 0 THEN NULL ELSE z END AS z FROM raster")
def q_header_nodata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster whose missing cells hold a number that its header names."""
    header = spark.createDataFrame([("samples = 24",), ("description = {mean values}",), ("data ignore value = -9999",)], "value STRING")
    cells = event_raster(spark, sf_dir).withColumn("z", F.when((F.col("i") + F.col("j")) % 7 == 0, -9999.0).otherwise(F.col("z")))
    return text.without_nodata(cells, header, "z")


def styled(layer: DataFrame, width: Callable[[Column], Column], colour: Callable[[Column], Column], kind: str = "kind") -> DataFrame:
    """A layer with the width and colour that the given functions make of each element's kind."""
    return layer.withColumns({"width": width(F.col(kind)), "colour": colour(F.col(kind))})


@query(f"WITH {POINTS_SQL}, {LINES_SQL} SELECT k, CASE w WHEN 8 THEN 3.0 WHEN 5 THEN 2.0 ELSE 1.0 END::DOUBLE AS width, CASE w WHEN 8 THEN '#d04020' ELSE '#808080' END AS colour FROM lines")
def q_styled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("k", F.col("w").alias("kind"))
    width = lambda w: F.when(w == 8, 3.0).when(w == 5, 2.0).otherwise(1.0)
    return styled(lines, width, lambda w: F.when(w == 8, "#d04020").otherwise("#808080")).drop("kind")


@query(f"""
WITH {_PARTS_SQL}, t AS (SELECT CAST(a * 3 AS DOUBLE) AS tx, CAST(b * 3 AS DOUBLE) AS ty FROM range(24) q(a), range(24) s(b)), o AS (SELECT *, x0 <= tx AND x0 + w >= tx + 3 AND y0 <= ty AND y0 + h >= ty + 3 AS inside FROM p JOIN t ON x0 < tx + 3 AND x0 + w > tx AND y0 < ty + 3 AND y0 + h > ty)
SELECT k, count(*) FILTER (WHERE inside) AS inside, count(*) FILTER (WHERE NOT inside) AS straddle FROM o GROUP BY k
""")
def q_polygon_mask_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each polygon, the tiles that it holds whole, which need no mask, and those that it cuts; other tiles are outside."""
    k, d, side = F.col("p_partkey"), lambda c: c.cast("double"), 3.0
    p = table(spark, sf_dir, "part").select(k.alias("k"), d(k * 7 % 50).alias("x0"), d(k * 13 % 50).alias("y0"), d(4 + F.col("p_size") % 9).alias("w"), d(4 + k % 6).alias("h"))
    x1, y1 = F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    ring = F.array(rings.point(F.col("x0"), F.col("y0")), rings.point(x1, F.col("y0")), rings.point(x1, y1), rings.point(F.col("x0"), y1))
    share = lambda edges, c: rings.area_in_box(edges, c["cx"] * side, c["cy"] * side, c["cx"] * side + side, c["cy"] * side + side) / (side * side)
    cells = cells_of_box(F.col("x0"), F.col("y0"), x1, y1, side)
    shares = p.select("k", rings.bound(rings.edges(ring), lambda edges: F.transform(cells, lambda c: share(edges, c))).alias("shares"))
    held = lambda test: F.sum(F.size(F.filter("shares", test))).alias
    whole = lambda s: s >= 1 - 1e-9
    return shares.groupBy("k").agg(held(whole)("inside"), held(lambda s: (s > 0) & ~whole(s))("straddle")).filter("inside + straddle > 0")
