import json

from pyspark.sql import functions as F

from geolith.sources import osm

RING = lambda a, b: [{"lon": x, "lat": y} for x, y in ((a, a), (b, a), (b, b), (a, b), (a, a))]
ELEMENTS = [
    {"type": "way", "id": 1, "tags": {"building": "yes"}, "geometry": RING(0, 4)},
    {"type": "way", "id": 2, "tags": {"building": "yes"}, "geometry": RING(0, 9)},
    {"type": "way", "id": 3, "tags": {"highway": "primary"}, "geometry": RING(0, 1)[:2]},
    {"type": "way", "id": 4, "tags": {"building": "yes"}, "geometry": RING(1, 1)},
    {"type": "way", "id": 5, "tags": {"building": "yes"}},
    {"type": "relation", "id": 9, "tags": {"building": "yes"}, "members": [
        {"type": "way", "ref": 2, "role": "outer", "geometry": RING(0, 9)}, {"type": "way", "ref": 6, "role": "inner", "geometry": RING(1, 2)}, {"type": "way", "ref": 7, "role": "", "geometry": RING(20, 22)},
        {"type": "way", "ref": 8, "role": "inner", "geometry": RING(50, 51)}, {"type": "node", "ref": 3, "role": "x"},
    ]},
    {"type": "node", "id": 20, "lat": 1.0, "lon": 2.0, "tags": {"aeroway": "aerodrome"}},
    {"type": "relation", "id": 21, "center": {"lat": 5.0, "lon": 6.0}, "tags": {"aeroway": "aerodrome"}},
]


def test_elements(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"elements": ELEMENTS}))
    rows = osm.elements(spark, str(tmp_path / "a.json"))
    houses = osm.polygons(osm.layer(rows, "buildings")).select("id", osm.area_with_holes(F.col("outer"), F.col("holes")).alias("a"), F.size("holes").alias("n"))
    assert sorted(map(tuple, houses.collect())) == [(1, 16.0, 0), (9, 4.0, 0), (9, 80.0, 1)]
    assert [(r["id"], len(r["line"])) for r in osm.lines(osm.layer(rows, "roads")).collect()] == [(3, 2)]
    assert sorted((r["id"], r["lon"], r["lat"]) for r in osm.points(osm.layer(rows, "aerodromes")).collect()) == [(20, 2.0, 1.0), (21, 6.0, 5.0)]
    widths = rows.filter("id IN (1, 3)").select("id", osm.width(F.col("tags")["highway"], osm.ROAD_WIDTHS, 6.0).alias("w"))
    assert sorted(map(tuple, widths.collect())) == [(1, 6.0), (3, 16.0)]


def test_manifest_falls_back_to_the_region(spark):
    rows = spark.createDataFrame([("A", "120", "u"), ("A", "121", "v"), ("B", "120", "w")], "Location STRING, QuadKey STRING, Url STRING")
    assert [r["url"] for r in osm.manifest(rows, "A", "120").collect()] == ["u"]
    assert sorted(r["url"] for r in osm.manifest(rows, "A", "33").collect()) == ["u", "v"]


def test_tiles():
    assert len(osm.tiles(20.0, 40.0, 23.0, 42.0, 0.85, True)) == 12 and len(osm.tiles(20.0, 40.0, 23.0, 42.0, 0.85, False)) == 1


def test_water_layer(spark):
    rows = [(1, "way", {"natural": "water"}), (2, "way", {"waterway": "dock"}), (3, "relation", {"landuse": "reservoir"}), (4, "way", {"water": "lake"}), (5, "node", {"natural": "water"}), (6, "way", {"waterway": "river"}), (7, "relation", {"waterway": "riverbank", "intermittent": "yes"})]
    d = osm.layer(spark.createDataFrame(rows, "id INT, type STRING, tags MAP<STRING, STRING>"), "water").withColumn("dry", osm.intermittent())
    assert {r["id"]: r["dry"] for r in d.collect()} == {1: False, 2: False, 3: False, 7: True}
