"""Text formats: headers, hash lines, waypoints, flight plans, feature collections, tilesets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import tags

#: First line of a waypoint file.
WAYPOINT_HEADER = "name,code,country,lat,lon,elev,style,rwdir,rwlen,freq,desc"
FEATURES = "type STRING, features ARRAY<STRUCT<type: STRING, properties: MAP<STRING, STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>>>"


def key_values(lines: DataFrame, separator: str = "=") -> DataFrame:
    """(key, value) of `value` lines such as 'key = {value}'."""
    parts = F.split("value", separator, 2)
    return lines.select(F.lower(F.trim(parts[0])).alias("key"), F.trim(F.regexp_replace(F.get(parts, F.lit(1)), r"[{}]", " ")).alias("value")).filter("value IS NOT NULL")


def hash_lines(lines: DataFrame) -> DataFrame:
    """(c, r, hash, passed) of lines 'CCRR value'; a hash must not be 0."""
    f = lines.select(F.split(F.trim("value"), r"\s+").alias("f")).select(F.col("f")[0].alias("code"), F.get("f", F.lit(1)).try_cast("long").alias("hash"))
    return f.select(F.substring("code", 1, 2).try_cast("int").alias("c"), F.substring("code", 3, 2).try_cast("int").alias("r"), "hash", F.coalesce(F.col("hash") != 0, F.lit(False)).alias("passed"))


def features(spark: SparkSession, path: str) -> DataFrame:
    """(properties, kind, coordinates) of GeoJSON collections; coordinates as JSON text. Features without geometry are left out."""
    rows = spark.read.schema(FEATURES).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return rows.select(F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates")).filter("kind IS NOT NULL")


def polygon_ring(coordinates: F.Column) -> F.Column:
    """The outer ring of a polygon's coordinates as (x, y) structs, without the repeated last vertex."""
    points = F.from_json(coordinates, "ARRAY<ARRAY<ARRAY<DOUBLE>>>")[0]
    return F.transform(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def feature_lines(rows: DataFrame, properties: list[str], ring: str, srid: int) -> DataFrame:
    """A JSON line for each feature, with its reference system; a polygon's ring is closed."""
    closed = F.transform(F.concat(F.col(ring), F.slice(ring, 1, 1)), lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates"))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.lit(f"EPSG:{srid}").alias("crs"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("value"))


def waypoint_lines(rows: DataFrame) -> DataFrame:
    """Lines after WAYPOINT_HEADER of (name, code, lat, lon, elevation_m, surface, heading, length_m, frequency)."""
    surface = F.lower("surface")
    style = F.when(surface.rlike("asphalt|concrete|paved"), 5).when(surface.rlike("grass|gravel|dirt"), 2).otherwise(3)
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit("'")), F.lit('"'))
    return rows.select(F.concat_ws(
        ",", quoted(F.col("name")), F.col("code"), F.lit(""), tags.degrees_minutes(F.col("lat"), 2, "N", "S"), tags.degrees_minutes(F.col("lon"), 3, "E", "W"), F.format_string("%.1fm", F.col("elevation_m").cast("double")),
        style.cast("string"), F.format_string("%03d", F.rint("heading").cast("int")), F.format_string("%.1fm", F.col("length_m").cast("double")), tags.trimmed_decimal(F.col("frequency").cast("double")), F.lit(""),
    ).alias("value"))


def plan_lines(points: DataFrame) -> DataFrame:
    """(plan, value): the lines of an INI-like flight plan from (plan, place, name, x, y), in order."""
    line = F.format_string("TPName%d=%s\nTPPosX%d=%.3f\nTPPosY%d=%.3f", "place", "name", "place", "x", "place", "y")
    rows = points.groupBy("plan").agg(F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("l"))
    return rows.select("plan", F.concat(F.lit("[Task]\nCount="), F.size("l").cast("string"), F.lit("\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("value"))


def header_lines(width: int, height: int, ulx: float, uly: float, step: float, nodata: int = -32768) -> list[str]:
    """The text header of a headerless raster of 16-bit integers."""
    return [f"NROWS {height}", f"NCOLS {width}", "NBANDS 1", "NBITS 16", "PIXELTYPE SIGNEDINT", "BYTEORDER I", f"ULXMAP {ulx:g}", f"ULYMAP {uly:g}", f"XDIM {step:g}", f"YDIM {step:g}", f"NODATA {nodata}"]


def mosaic_offsets(tiles: DataFrame, size: int) -> DataFrame:
    """(path, x, y, left, top): each tile's offset in the mosaic of all; rows are counted upwards in names, downwards here."""
    span = tiles.agg(F.min("x").alias("x0"), F.max("y").alias("y1"))
    return tiles.crossJoin(F.broadcast(span)).select("path", "x", "y", ((F.col("x") - F.col("x0")) * size).alias("left"), ((F.col("y1") - F.col("y")) * size).alias("top"))  # span is one row


def without_nodata(cells: DataFrame, lines: DataFrame, value: str, key: str = "data ignore value") -> DataFrame:
    """Cells whose value is the one that the header's lines name as missing get null; without such a line they stay."""
    header = key_values(lines).filter(F.col("key") == key).agg(F.max(F.col("value").try_cast("double")).alias("nodata"))  # one row
    return cells.crossJoin(F.broadcast(header)).withColumn(value, F.when(F.col(value).eqNullSafe(F.col("nodata")), None).otherwise(F.col(value))).drop("nodata")


def in_metres(features: DataFrame, zone: str = "32634") -> DataFrame:
    """(collection, metres) of (collection, place, crs, x, y): whether its tag names the zone or its first coordinate is no degree.

    Features without coordinates don't count; an untagged collection of such alone is taken to be in metres.
    """
    first = F.min_by(F.struct("x", "y"), F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.col("place")))
    found = features.groupBy("collection").agg(F.max(F.coalesce(F.contains("crs", F.lit(zone)), F.lit(False))).alias("tagged"), first.alias("p"))
    degrees = (F.abs("p.x") <= 180) & (F.abs("p.y") <= 90)
    return found.select("collection", (F.col("tagged") | ~F.coalesce(degrees, F.lit(False))).alias("metres"))


def mosaic_lines(tiles: DataFrame, size: int, step: float, left: float, bottom: float, srs: str, bands: int = 3) -> DataFrame:
    """(band, place, y, x, value): the lines of a virtual mosaic in XML, in the order of these columns; no tiles, no lines."""
    extent = tiles.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).filter("x0 IS NOT NULL")
    n = lambda a, b: ((F.col(b) - F.col(a) + 1) * size).cast("long")
    corner = (F.lit(left) + F.col("x0") * size * step).cast("double"), (F.lit(bottom) + (F.col("y1") + 1) * size * step).cast("double")
    at = lambda place: (F.lit(place).alias("place"), F.lit(None).cast("long").alias("y"), F.lit(None).cast("long").alias("x"))
    head = F.format_string(f'<VRTDataset rasterXSize="%d" rasterYSize="%d"><SRS>{srs}</SRS><GeoTransform>%.6f, {step:.6f}, 0, %.6f, 0, {-step:.6f}</GeoTransform>', n("x0", "x1"), n("y0", "y1"), *corner)
    every = extent.select(F.explode(F.sequence(F.lit(1), F.lit(bands))).alias("band"))
    opened = every.select("band", *at(1), F.format_string('<VRTRasterBand dataType="Byte" band="%d">', "band").alias("value"))
    closed = every.select("band", *at(3), F.lit("</VRTRasterBand>").alias("value"))
    square = f'xSize="{size}" ySize="{size}"'
    source = F.format_string(
        f'<SimpleSource><SourceFilename relativeToVRT="0">%s</SourceFilename><SourceBand>%d</SourceBand><SrcRect xOff="0" yOff="0" {square}/><DstRect xOff="%d" yOff="%d" {square}/></SimpleSource>',
        F.replace("path", F.lit("&"), F.lit("&amp;")), "band", "left", "top",
    )
    placed = mosaic_offsets(tiles, size).withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(bands))))
    sources = placed.select("band", F.lit(2).alias("place"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), source.alias("value"))
    first = extent.select(F.lit(0).alias("band"), *at(0), head.alias("value"))
    last = extent.select(F.lit(bands + 1).alias("band"), *at(0), F.lit("</VRTDataset>").alias("value"))
    return first.unionByName(opened).unionByName(sources).unionByName(closed).unionByName(last)


def sidecar_lines(rows: DataFrame) -> DataFrame:
    """A JSON object for each row of statistics."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def tile_folder(x: F.Column, y: F.Column, of: int = 256) -> F.Column:
    """Folder of a tile, so that none holds more than of x of tiles."""
    return F.concat(F.lit("x"), F.floor(x / of).cast("string"), F.lit("/y"), F.floor(y / of).cast("string"))
