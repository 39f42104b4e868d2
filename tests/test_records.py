"""Projections, reference systems, mosaics, folders and missing cells."""

import math
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from geolith.functions import geo
from geolith.functions.colour import clamped_shift
from geolith.sources import text


def test_equal_area_example(spark):
    """The published example of the projection's method: 50 N 5 E, and its centre."""
    df = spark.createDataFrame([(5.0, 50.0), (10.0, 52.0)], "lon DOUBLE, lat DOUBLE")
    e, n = geo.laea_forward(F.col("lon"), F.col("lat"))
    there = df.select("lon", "lat", e.alias("e"), n.alias("n"))
    lon, lat = geo.laea_inverse(F.col("e"), F.col("n"))
    rows = sorted(there.select("lon", "lat", "e", "n", lon.alias("lon2"), lat.alias("lat2")).collect())
    assert abs(rows[0]["e"] - 3962799.45) < 0.01 and abs(rows[0]["n"] - 2999718.85) < 0.01
    assert abs(rows[1]["e"] - 4321000) < 1e-3 and abs(rows[1]["n"] - 3210000) < 1e-3
    assert all(abs(r["lon"] - r["lon2"]) < 1e-6 and abs(r["lat"] - r["lat2"]) < 1e-6 for r in rows)


def test_directions(spark):
    df = spark.createDataFrame([(10.0, 12.0), (10.0, 192.0), (350.0, 3.0), (350.0, 183.0), (90.0, 0.0)], "h DOUBLE, a DOUBLE")
    assert [r[0] for r in df.select(geo.nearer_direction(F.col("h"), F.col("a"))).collect()] == [12.0, 12.0, 3.0, 3.0, 180.0]
    turns = spark.createDataFrame([(-90.0,), (0.0,), (360.0,), (725.0,)], "h DOUBLE").select(geo.orientation(F.col("h"))).collect()
    assert [round(r[0], 9) for r in turns] == [round(v, 9) for v in (1.5 * math.pi, 0.0, 0.0, math.radians(5))]


def test_flat_channel_keeps_its_values(spark):
    row = spark.range(1).select(clamped_shift(F.lit(5.0), F.lit(5.0), F.lit(0.0), F.lit(7.0), F.lit(2.0), 10.0).alias("far"), clamped_shift(F.lit(5.0), F.lit(5.0), F.lit(0.0), F.lit(70.0), F.lit(2.0), 10.0).alias("clamped")).first()
    assert row == (2.0, 10.0)


def test_reference_systems(spark):
    rows = [
        ("tagged", 0, "urn:ogc:def:crs:EPSG::32634", 21.0, 41.0), ("degrees", 1, None, 21.0, 41.0), ("degrees", 2, None, 5e5, 4.6e6),
        ("metres", 0, None, None, None), ("metres", 1, None, 5e5, 4.6e6), ("bare", 0, None, None, None),
    ]
    df = spark.createDataFrame(rows, "collection STRING, place LONG, crs STRING, x DOUBLE, y DOUBLE")
    assert {r[0]: r[1] for r in text.in_metres(df).collect()} == {"tagged": True, "degrees": False, "metres": True, "bare": True}
    assert text.in_metres(df.limit(0)).count() == 0


def test_mosaic_is_xml(spark):
    tiles = spark.createDataFrame([("a&b.jpg", 4, 9), ("c.jpg", 6, 8)], "path STRING, x LONG, y LONG")
    lines = text.mosaic_lines(tiles, 256, 0.5, 1000.0, 2000.0, "EPSG:6316")
    root = ET.fromstring("\n".join(r["value"] for r in lines.orderBy("band", "place", "y", "x").collect()))
    assert (root.get("rasterXSize"), root.get("rasterYSize")) == ("768", "512")
    assert [float(v) for v in root.find("GeoTransform").text.split(",")] == [1512.0, 0.5, 0.0, 3280.0, 0.0, -0.5]
    for band in root.findall("VRTRasterBand"):
        assert {s.find("SourceFilename").text: (s.find("DstRect").get("xOff"), s.find("DstRect").get("yOff")) for s in band.findall("SimpleSource")} == {"a&b.jpg": ("0", "0"), "c.jpg": ("512", "256")}
    assert [b.get("band") for b in root.findall("VRTRasterBand")] == ["1", "2", "3"]


def test_missing_cells(spark):
    cells = spark.createDataFrame([(1, -9999.0), (2, 5.0), (3, None)], "i INT, z DOUBLE")
    header = spark.createDataFrame([("samples = 3",), ("Data Ignore Value = {-9999}",)], "value STRING")
    rows = lambda df: {r["i"]: r["z"] for r in df.collect()}
    assert rows(text.without_nodata(cells, header, "z")) == {1: None, 2: 5.0, 3: None}
    assert rows(text.without_nodata(cells, header.limit(1), "z")) == {1: -9999.0, 2: 5.0, 3: None}


def test_folders(spark):
    df = spark.createDataFrame([(0, 255), (256, 511), (1000, 512)], "x LONG, y LONG")
    assert [r[0] for r in df.select(text.tile_folder(F.col("x"), F.col("y"))).collect()] == ["x0/y0", "x1/y1", "x3/y2"]
