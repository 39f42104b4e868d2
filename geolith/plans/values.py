"""Scalar queries: tags, codes, formats, URLs, text records and nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import tags
from geolith.operators.ranking import first_of
from geolith.plans.registry import Registry
from geolith.plans.tables import table
from geolith.plans.vectors import PLACES_SQL, supplier_places

query = Registry()


@query("""
WITH t AS (SELECT event_id, json_extract_string(props, '$.k') AS k, value, CASE event_id % 4 WHEN 0 THEN CAST(value AS VARCHAR) || ' m' WHEN 1 THEN replace(CAST(value AS VARCHAR), '.', ',') WHEN 2 THEN '' ELSE 'about ' || CAST(value AS VARCHAR) END AS tag FROM events)
SELECT event_id, coalesce(TRY_CAST(k AS INT), -1) AS k, TRY_CAST(split_part(trim(replace(replace(lower(tag), 'm', ''), ',', '.')), ' ', 1) AS DOUBLE) AS number FROM t
""")
def q_numeric_tag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value").cast("string")
    k = F.col("event_id") % 4
    tag = F.when(k == 0, F.concat(v, F.lit(" m"))).when(k == 1, F.replace(v, F.lit("."), F.lit(","))).when(k == 2, "").otherwise(F.concat(F.lit("about "), v))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"), tags.number(tag).alias("number"))


@query("""
WITH t AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS levels, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_retailprice / 100 END AS height FROM part)
SELECT p_partkey, coalesce(levels * 3.0, height, 3.0)::DOUBLE AS a, coalesce(height, levels * 3.0 + 3.0, 9.0)::DOUBLE AS b, coalesce(levels * 3.0 + 3.0, 9.0)::DOUBLE AS c, round(least(greatest(sqrt(p_size * 40.0) * 0.5, 6), 28), 6) AS d FROM t JOIN part USING (p_partkey)
""")
def q_height_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels, height = F.when(F.col("p_size") % 3 != 0, F.col("p_size")), F.when(F.col("p_size") % 4 != 0, F.col("p_retailprice") / 100)
    return table(spark, sf_dir, "part").select("p_partkey", tags.height_from_levels(levels, height).alias("a"), tags.height_first(height, levels).alias("b"), tags.height_of_floors(levels).alias("c"), F.round(tags.height_from_area(F.col("p_size") * 40.0), 6).alias("d"))


@query(f"""
WITH {PLACES_SQL}, m AS (SELECT s_suppkey, lat, floor(abs(lat)) AS d, (abs(lat) - floor(abs(lat))) * 60 AS mm, lon, floor(abs(lon)) AS e, (abs(lon) - floor(abs(lon))) * 60 AS nn FROM places)
SELECT s_suppkey, printf('%02d%02d', s_suppkey % 40, s_suppkey % 32) AS code, printf('%02d%06.3f', CAST(d AS INT), mm) || 'N' AS lat, printf('%03d%06.3f', CAST(e AS INT), nn) || 'E' AS lon, CAST(round_even((s_suppkey * 1.5) * 3.28084, 0) AS INT) AS feet FROM m
""")
def q_code_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier_places(spark, sf_dir).select("s_suppkey", tags.cell_code(k % 40, k % 32).alias("code"), tags.degrees_minutes(F.col("lat"), 2, "N", "S").alias("lat"), tags.degrees_minutes(F.col("lon"), 3, "E", "W").alias("lon"), tags.feet(k * 1.5).alias("feet"))


@query(r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, coalesce(TRY_CAST(regexp_extract(url, '/([0-9]+)(\?|#|$)', 1) AS INT), -1) AS number, lower(url) LIKE '%ref=%' AS tracked, 'z12_x' || CAST(page_id AS VARCHAR) || '.jpg' AS tile FROM pages
""")
def q_url_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(u, r"^https?://([^/]+)/", 1).alias("host"), F.coalesce(F.regexp_extract(u, r"/([0-9]+)(\?|#|$)", 1).try_cast("int"), F.lit(-1)).alias("number"), F.lower(u).contains("ref=").alias("tracked"),
        F.concat(F.lit("z12_x"), F.col("page_id").cast("string"), F.lit(".jpg")).alias("tile"),
    )


@query(r"""
SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type), 'economy|standard') THEN 5 WHEN lower(p_type) = 'small' THEN 2 ELSE 3 END AS style, regexp_replace(printf('%.3f', p_retailprice / 7), '\.?0+$', '') AS frequency,
       rpad(regexp_replace(p_name, '[^\x00-\x7F]', '', 'g'), 12, '_') AS field, contains(lower(p_name), 'ring') AS ring
FROM part
""")
def q_string_misc(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, name = F.lower("p_type"), F.col("p_name")
    style = F.when(kind.rlike("economy|standard"), 5).when(kind == "small", 2).otherwise(3)
    return table(spark, sf_dir, "part").select("p_partkey", style.alias("style"), tags.trimmed_decimal(F.col("p_retailprice") / 7).alias("frequency"), tags.ascii_field(name, 12).alias("field"), F.lower(name).contains("ring").alias("ring"))


@query("""
SELECT o_orderkey, round(CASE WHEN o_totalprice <= 100000 THEN 10 + o_totalprice / 100000 * 40 WHEN o_totalprice <= 300000 THEN 50 + (o_totalprice - 100000) / 200000 * 150 WHEN o_totalprice <= 500000 THEN 200 + (o_totalprice - 300000) / 200000 * 55 ELSE 255 END, 8) AS tint FROM orders
""")
def q_hypsometric_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice")
    tint = F.when(p <= 100000, p / 100000 * 40 + 10).when(p <= 300000, (p - 100000) / 200000 * 150 + 50).when(p <= 500000, (p - 300000) / 200000 * 55 + 200).otherwise(255.0)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(tint, 8).alias("tint"))


@query("""
WITH l AS (SELECT printf('%02d%02d', n_nationkey, n_regionkey) || '  ' || CASE WHEN n_nationkey % 6 = 5 THEN 'x' ELSE CAST(n_nationkey * 31 % 7 AS VARCHAR) END AS line FROM nation), p AS (SELECT regexp_split_to_array(line, '\\s+') AS f FROM l)
SELECT TRY_CAST(substr(f[1], 1, 2) AS INT) AS c, TRY_CAST(substr(f[1], 3, 2) AS INT) AS r, coalesce(TRY_CAST(f[2] AS BIGINT), 0) AS hash, coalesce(TRY_CAST(f[2] AS BIGINT) <> 0, false) AS passed FROM p
""".replace("\\\\s", "\\s"))
def q_hash_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    lines = table(spark, sf_dir, "nation").select(F.concat(tags.cell_code(k, F.col("n_regionkey")), F.lit("  "), F.when(k % 6 == 5, "x").otherwise((k * 31 % 7).cast("string"))).alias("line"))
    f = lines.select(F.split("line", r"\s+").alias("f")).select(F.col("f")[0].alias("code"), F.coalesce(F.col("f")[1].try_cast("long"), F.lit(0)).alias("hash"))
    return f.select(F.substring("code", 1, 2).try_cast("int").alias("c"), F.substring("code", 3, 2).try_cast("int").alias("r"), "hash", (F.col("hash") != 0).alias("passed"))


@query("""
WITH w AS (SELECT l_orderkey AS way, l_partkey AS node FROM lineitem), m AS (SELECT DISTINCT o_orderkey AS way FROM orders WHERE o_orderstatus = 'P')
SELECT way, count(*) AS points, round(avg(node), 6) AS middle, count(*) >= 4 AS area FROM w WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.way = w.way) GROUP BY way HAVING count(*) >= 2
""")
def q_overpass_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways with their points gathered; members of relations are left out, and so are ways of one point."""
    ways = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("way"), F.col("l_partkey").alias("node"))
    members = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("way"))
    n = F.count(F.lit(1))
    return ways.join(members, "way", "left_anti").groupBy("way").agg(n.alias("points"), F.round(F.avg("node"), 6).alias("middle"), (n >= 4).alias("area")).filter("points >= 2")


@query("""
SELECT s_suppkey AS airport, k AS runway, CASE k WHEN 0 THEN heading ELSE (heading + 180) % 360 END AS heading, printf('%02d', CAST(CASE k WHEN 0 THEN heading ELSE (heading + 180) % 360 END AS INT) // 10) AS designation
FROM (SELECT s_suppkey, ((s_suppkey * 53) % 360)::DOUBLE AS heading FROM supplier), (VALUES (0), (1)) v(k)
""")
def q_airports_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports as nested JSON with two runway ends each, read back with a schema and unnested."""
    h = F.col("heading")
    ends = F.array(F.struct(h.alias("true_heading")), F.struct(F.pmod(h + 180, F.lit(360.0)).alias("true_heading")))
    text = supplier_places(spark, sf_dir).select(F.to_json(F.struct(F.col("s_suppkey").alias("icao"), F.struct("lon", "lat").alias("place"), F.array(F.struct(ends.alias("ends"))).alias("runways"))).alias("json"))
    schema = "icao BIGINT, place STRUCT<lon: DOUBLE, lat: DOUBLE>, runways ARRAY<STRUCT<ends: ARRAY<STRUCT<true_heading: DOUBLE>>>>"
    rows = text.select(F.from_json("json", schema).alias("a")).select(F.col("a.icao").alias("airport"), F.explode("a.runways").alias("r")).select("airport", F.posexplode("r.ends").alias("runway", "e"))
    return rows.select("airport", "runway", F.col("e.true_heading").alias("heading"), F.format_string("%02d", F.floor(F.col("e.true_heading") / 10)).alias("designation"))


@query("""
WITH k AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text) AS n FROM conversations) SELECT conv_id, turn, role, md5(coalesce(text, '')) AS digest FROM k WHERE n = 1
""")
def q_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of(table(spark, sf_dir, "conversations"), ["conv_id"], [F.desc("turn"), "text"]).select("conv_id", "turn", "role", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))


@query("""
SELECT url, host, CASE WHEN tile < 3 THEN 'x0' ELSE 'x1' END AS folder FROM (SELECT url, regexp_extract(url, '//([^/]+)', 1) AS host, page_id % 5 AS tile FROM pages WHERE length(html) > 100)
UNION ALL SELECT 'https://tiles.example.org/' || CAST(n_nationkey AS VARCHAR) || '?layer=' || replace(n_name, ' ', '%20') AS url, 'tiles.example.org' AS host, 'x2' AS folder FROM nation
""")
def q_listing_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").filter(F.length("html") > 100)
    a = p.select("url", F.regexp_extract("url", "//([^/]+)", 1).alias("host"), F.when(F.col("page_id") % 5 < 3, "x0").otherwise("x1").alias("folder"))
    b = table(spark, sf_dir, "nation").select(F.concat(F.lit("https://tiles.example.org/"), F.col("n_nationkey").cast("string"), F.lit("?layer="), F.replace(F.col("n_name"), F.lit(" "), F.lit("%20"))).alias("url"))
    return a.unionByName(b.select("url", F.lit("tiles.example.org").alias("host"), F.lit("x2").alias("folder")))
