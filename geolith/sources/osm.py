"""Map elements (nodes, ways, relations as nested JSON) as polygons, lines and points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import rings

PLACE = "STRUCT<lat: DOUBLE, lon: DOUBLE>"
ELEMENT = f"type: STRING, id: BIGINT, lat: DOUBLE, lon: DOUBLE, center: {PLACE}, tags: MAP<STRING, STRING>, geometry: ARRAY<{PLACE}>, members: ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING, geometry: ARRAY<{PLACE}>>>"

#: Classes of each layer, and widths in metres.
ROADS = "motorway motorway_link trunk trunk_link primary primary_link secondary secondary_link tertiary tertiary_link unclassified residential living_street pedestrian track path cycleway service road".split()
RAILWAYS = "rail light_rail narrow_gauge tram subway".split()
WATERWAYS = "river stream canal drain ditch".split()
RUNWAYS = "runway taxiway apron".split()
SETTLEMENTS = "residential commercial industrial retail".split()
ROAD_WIDTHS = {
    "motorway": 28.0, "motorway_link": 14.0, "trunk": 22.0, "trunk_link": 12.0, "primary": 16.0, "primary_link": 10.0, "secondary": 12.0, "secondary_link": 8.0, "tertiary": 10.0, "tertiary_link": 8.0,
    "unclassified": 8.0, "residential": 8.0, "living_street": 7.0, "pedestrian": 6.0, "service": 6.0, "track": 5.0, "path": 3.0, "cycleway": 3.0, "road": 7.0,
}
WATERWAY_WIDTHS = {"river": 20.0, "canal": 12.0, "stream": 4.0, "drain": 3.0, "ditch": 2.0}
URBAN_BUFFERS = {"residential": 8.0, "industrial": 5.0, "commercial": 5.0, "retail": 5.0}


def _one_of(key: str, values: list[str], kinds: tuple[str, ...]) -> Callable[[], Column]:
    return lambda: F.col("type").isin(*kinds) & F.col("tags")[key].isin(*values)


#: Layer -> the predicate of its elements.
LAYERS: dict[str, Callable[[], Column]] = {
    "water": lambda: F.col("type").isin("way", "relation") & ((F.col("tags")["natural"] == "water") | F.col("tags")["waterway"].isin("riverbank", "dock") | (F.col("tags")["landuse"] == "reservoir")),
    "forest": lambda: F.col("type").isin("way", "relation") & ((F.col("tags")["landuse"] == "forest") | (F.col("tags")["natural"] == "wood")),
    "waterways": _one_of("waterway", WATERWAYS, ("way",)),
    "roads": _one_of("highway", ROADS, ("way",)),
    "railways": _one_of("railway", RAILWAYS, ("way",)),
    "buildings": lambda: F.col("type").isin("way", "relation") & F.col("tags")["building"].isNotNull(),
    "runways": _one_of("aeroway", RUNWAYS, ("way", "relation")),
    "settlements": _one_of("landuse", SETTLEMENTS, ("way", "relation")),
    "aerodromes": _one_of("aeroway", ["aerodrome"], ("node", "way", "relation")),
}


def elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of JSON answers, one row each."""
    return spark.read.schema(f"elements ARRAY<STRUCT<{ELEMENT}>>").option("multiLine", True).json(path).select(F.inline("elements"))


def layer(rows: DataFrame, name: str) -> DataFrame:
    if name not in LAYERS:
        raise ValueError(f"no such layer: {name}")
    return rows.filter(LAYERS[name]())


def intermittent() -> Column:
    """Whether an element is tagged as running dry."""
    return F.coalesce(F.col("tags")["intermittent"] == "yes", F.lit(False))


def width(tag: Column, widths: dict[str, float], default: float) -> Column:
    """A class's width, else the default."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in widths.items() for x in pair])[tag], F.lit(default))


def _open_ring(geometry: Column) -> Column:
    """Vertices as (x, y), without a repeated last one."""
    points = F.transform(geometry, lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    closed = (F.size(points) > 1) & (F.get(points, F.lit(0)) == F.get(points, F.size(points) - 1))
    return F.when(closed, F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0)))).otherwise(points)


def polygons(rows: DataFrame) -> DataFrame:
    """(id, type, tags, outer, holes): a row for each outer ring.

    Ways that are members of a relation are left out, as the relation brings them; so are invalid rings. A hole goes to
    the first outer ring that holds its first vertex, and nowhere if none does. Roles other than inner count as outer.
    """
    member = rows.filter("type = 'relation'").select(F.explode("members").alias("m")).filter("m.type = 'way'").select(F.col("m.ref").alias("id")).distinct()
    ways = rows.filter("type = 'way' AND geometry IS NOT NULL").join(member, "id", "left_anti").select("id", "type", "tags", _open_ring(F.col("geometry")).alias("outer"))
    ways = ways.filter(rings.valid(F.col("outer"))).withColumn("holes", F.array().cast("array<array<struct<x:double,y:double>>>"))
    parts = rows.filter("type = 'relation'").select("id", "type", "tags", F.posexplode("members").alias("place", "m")).filter("m.type = 'way' AND m.geometry IS NOT NULL")
    parts = parts.select("id", "type", "tags", "place", (F.col("m.role") == "inner").alias("inner"), _open_ring(F.col("m.geometry")).alias("ring")).filter(rings.valid(F.col("ring")))
    outer = parts.filter(~F.coalesce("inner", F.lit(False))).select("id", "type", "tags", "place", F.col("ring").alias("outer"))
    inner = parts.filter("inner").select("id", F.col("place").alias("hole"), F.col("ring"))
    first = F.col("ring")[0]
    held = inner.join(outer.select("id", "place", "outer"), "id").filter(rings.contains(F.col("outer"), first["x"], first["y"])).groupBy("id", "hole").agg(F.min("place").alias("place"), F.first("ring").alias("ring"))
    holes = held.groupBy("id", "place").agg(F.sort_array(F.collect_list(F.struct("hole", "ring"))).alias("h"))
    whole = outer.join(holes, ["id", "place"], "left").select("id", "type", "tags", "outer", F.coalesce(F.transform("h", lambda h: h["ring"]), F.array().cast("array<array<struct<x:double,y:double>>>")).alias("holes"))
    return ways.unionByName(whole)


def lines(rows: DataFrame) -> DataFrame:
    """(id, tags, line) of ways with two vertices or more."""
    return rows.filter("type = 'way' AND size(geometry) >= 2").select("id", "tags", F.transform("geometry", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))).alias("line"))


def points(rows: DataFrame) -> DataFrame:
    """(id, type, tags, lon, lat): a node's place, else the mean of the vertices, else the centre given."""

    def mean(k: str) -> Column:
        return F.when(F.size("geometry") > 0, F.aggregate("geometry", F.lit(0.0), lambda a, p: a + p[k]) / F.size("geometry"))

    at = {k: F.when(F.col("type") == "node", F.col(k)).otherwise(F.coalesce(mean(k), F.col("center")[k])) for k in ("lon", "lat")}
    return rows.select("id", "type", "tags", at["lon"].alias("lon"), at["lat"].alias("lat")).filter("lon IS NOT NULL AND lat IS NOT NULL")


def area_with_holes(outer: Column, holes: Column) -> Column:
    return F.abs(rings.signed_area(outer)) - F.aggregate(holes, F.lit(0.0), lambda a, h: a + F.abs(rings.signed_area(h)))


def manifest(rows: DataFrame, region: str, prefix: str) -> DataFrame:
    """(location, quadkey, url) of a dataset list: the region's rows under a prefix of their key, else all of the region's.

    The region's column is Location, or RegionName in older lists.
    """
    place = F.col("Location" if "Location" in rows.columns else "RegionName")
    own = rows.filter(place == region).select(place.alias("location"), F.col("QuadKey").cast("string").alias("quadkey"), F.col("Url").alias("url"))
    near = own.filter(F.col("quadkey").startswith(prefix))
    none = near.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(True).alias("none"))
    return near.unionByName(own.join(F.broadcast(none), F.lit(True), "left_semi"))  # one row or none


def tiles(west: float, south: float, east: float, north: float, step: float, dense: bool) -> list[tuple[int, int, float, float, float, float]]:
    """Sub-boxes (column, row, west, south, east, north) of a dense layer's box; a sparse layer is asked for as a whole."""
    if not dense:
        return [(0, 0, west, south, east, north)]
    n, m = (max(1, -int(-(b - a) // step)) for a, b in ((west, east), (south, north)))
    x, y = (east - west) / n, (north - south) / m
    return [(i, j, west + i * x, south + j * y, west + (i + 1) * x, south + (j + 1) * y) for i in range(n) for j in range(m)]
