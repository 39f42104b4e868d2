"""Codecs, files, text formats, the ledger and the stage runner."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolith.operators import freshness
from geolith.sources import files, formats, text
from geolith.streaming import ledger


def test_sizes_of_layouts():
    assert (formats.OBJECT.itemsize, formats.AIRPORT.itemsize, formats.OVERVIEW.itemsize) == (152, 72, 36)


def test_patches_round_trip():
    z = np.random.default_rng(1).integers(0, 3000, (193, 193))
    content = formats.encode_patch(z)
    assert len(content) == 74498 and (formats.decode_patch(content, 193) == z).all()
    with pytest.raises(ValueError):
        formats.decode_patch(content[:-2], 193)
    m = np.random.default_rng(2).integers(0, 3, (512, 512))
    assert len(formats.encode_patch(m, "u1")) == 262144 and (formats.decode_patch(formats.encode_patch(m, "u1"), 512, "u1") == m).all()


def test_overview_and_maps():
    z = np.arange(12).reshape(3, 4)
    head, back = formats.decode_overview(formats.encode_overview(z, 5.0, 6.0, 34))
    assert (back == z).all() and int(head["zone"]) == 34 and chr(head["hemisphere"]) == "N"
    assert (formats.decode_bytes_map(formats.encode_bytes_map(z)) == z).all()
    assert formats.decode_heights(np.array([[-32768, 5], [7, -1]], "<i2").tobytes(), 2, 2).tolist() == [[0, 5], [7, 0]]
    with pytest.raises(ValueError):
        formats.decode_heights(b"\0" * 6, 2, 2)


def test_records_through_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"Obj é {k}", float(k), k / 2, 0.0, 1.0, 3.0) for k in range(20)], "name STRING, x FLOAT, y FLOAT, z FLOAT, scale FLOAT, heading FLOAT")
    out = files.encoded_records(rows, "object").select(F.format_string("%s/%s.obj", F.lit("o"), F.col("x").cast("int")).alias("name"), F.col("record").alias("content"))
    spark.dataSource.register(files.FileSink)
    out.write.format("geolith_files").mode("append").save(str(tmp_path))
    assert {p.stat().st_size for p in (tmp_path / "o").iterdir()} == {152}
    back = files.decoded_records(files.binary_files(spark, str(tmp_path), "*.obj"), "object").collect()
    assert sorted((r["name"], r["x"], r["y"]) for r in back) == sorted((f"Obj  {k}", float(k), k / 2) for k in range(20))
    listed = files.listing(spark, str(tmp_path), r"(\d)(\d)\.obj").collect()
    assert sorted((r["x"], r["y"]) for r in listed) == [(1, k) for k in range(10)]


def test_airports(spark):
    rows = spark.createDataFrame([("Skop", 41.9, 21.6, 238.0, 160, 2450, 45, 118.5)], "name STRING, lat FLOAT, lon FLOAT, elevation FLOAT, direction INT, length INT, width INT, frequency FLOAT")
    coded = files.encoded_records(rows, "airport").select(F.lit("a").alias("path"), F.col("record").alias("content"))
    assert len(coded.first()["content"]) == 72
    assert files.decoded_records(coded, "airport").drop("path", "place").exceptAll(rows.select("name", "lat", "lon", "elevation", "direction", "length", "width", "frequency")).count() == 0


def test_grids(spark):
    z = np.arange(9).reshape(3, 3)
    cells = spark.createDataFrame([(c, 0, int(i), int(j), int(z[i, j]) + c) for c in (1, 2) for i in range(3) for j in range(3)], "c INT, r INT, i INT, j INT, z INT")
    coded = files.encoded_grids(cells, 3, formats.encode_patch)
    back = files.decoded_grids(coded.select(F.col("c").cast("string").alias("path"), "content"), lambda b: formats.decode_patch(b, 3))
    assert sorted((int(r["path"]), r["i"], r["j"], r["z"]) for r in back.collect()) == sorted((r["c"], r["i"], r["j"], r["z"]) for r in cells.collect())


def test_text_formats(spark, tmp_path):
    lines = lambda rows: spark.createDataFrame([(r,) for r in rows], "value STRING")
    assert dict(map(tuple, text.key_values(lines(["samples = 12", "map info = {UTM, 1}", "ENVI"])).collect())) == {"samples": "12", "map info": "UTM, 1"}
    assert sorted(map(tuple, text.hash_lines(lines(["0102 77", "0304 0", "0506"])).collect()), key=str) == [(1, 2, 77, True), (3, 4, 0, False), (5, 6, None, False)]
    fc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": "1"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 1], [0, 0]]]}}, {"type": "Feature", "properties": {}, "geometry": None}]}
    (tmp_path / "f.json").write_text(json.dumps(fc))
    got = text.features(spark, str(tmp_path / "f.json")).select("properties", text.polygon_ring(F.col("coordinates")).alias("ring")).collect()
    assert len(got) == 1 and got[0]["properties"] == {"a": "1"} and [tuple(p) for p in got[0]["ring"]] == [(0, 0), (2, 0), (2, 1)]
    line = json.loads(text.feature_lines(text.features(spark, str(tmp_path / "f.json")).select(F.lit("n").alias("name"), text.polygon_ring(F.col("coordinates")).alias("ring")), ["name"], "ring", 32634).first()[0])
    assert line["crs"] == "EPSG:32634" and line["geometry"]["coordinates"][0][0] == line["geometry"]["coordinates"][0][-1]
    place = spark.createDataFrame([('A "b"', "AB", 41.5, 21.25, 238.0, "Asphalt", 160.0, 2450.0, 118.5)], "name STRING, code STRING, lat DOUBLE, lon DOUBLE, elevation_m DOUBLE, surface STRING, heading DOUBLE, length_m DOUBLE, frequency DOUBLE")
    assert text.waypoint_lines(place).first()[0] == "\"A 'b'\",AB,,4130.000N,02115.000E,238.0m,5,160,2450.0m,118.5,"
    plan = spark.createDataFrame([("p", 1, "B", 3.0, 4.0), ("p", 0, "A", 1.0, 2.0)], "plan STRING, place INT, name STRING, x DOUBLE, y DOUBLE")
    assert text.plan_lines(plan).first()["value"].split("\n")[:3] == ["[Task]", "Count=2", "TPName0=A"]
    tiles = spark.createDataFrame([("a", 5, 9), ("b", 6, 8)], "path STRING, x INT, y INT")
    assert sorted(map(tuple, text.mosaic_offsets(tiles, 256).collect())) == [("a", 5, 9, 0, 0), ("b", 6, 8, 256, 256)]
    assert text.header_lines(3, 2, 1.5, 2.5, 30)[:2] == ["NROWS 2", "NCOLS 3"]


def test_ledger(spark):
    at = lambda k: dt.datetime(2024, 1, 1, k)
    events = spark.createDataFrame([("a", "error", 0, at(1)), ("a", "done", 5, at(2)), ("b", "done", 1, at(1)), ("b", "error", 0, at(3)), ("c", "split", 9, at(1))], ledger.EVENTS)
    tiles = spark.createDataFrame([(t,) for t in "abcd"], "tile STRING")
    assert sorted(r["tile"] for r in ledger.pending(tiles, events).collect()) == ["b", "d"]
    assert sum(r["n"] for r in ledger.counts_by_window(events).collect()) == 5


def test_stream_appends_each_key_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    row = lambda k, m: json.dumps({"id": k, "at": f"2024-01-01T00:{m:02d}:00"})
    schema = "id STRING, at TIMESTAMP"
    (tmp_path / "in/1.json").write_text("\n".join([row("a", 1), row("b", 2), row("a", 3)]))
    ledger.append_new(spark, source, target, state, schema, "id", "at").awaitTermination(120)
    (tmp_path / "in/2.json").write_text("\n".join([row("b", 4), row("c", 5)]))
    ledger.append_new(spark, source, target, state, schema, "id", "at").awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.schema(schema).parquet(target).collect()) == ["a", "b", "c"]


def test_stages(spark, tmp_path):
    rows = [("one", "input", 10), ("one", "output", 9), ("two", "input", 9), ("two", "output", 3), ("three", "input", 3), ("three", "output", None), ("check", "input", 3)]
    parts = spark.createDataFrame(rows, "stage STRING, role STRING, t INT").selectExpr("stage", "role", "timestamp_seconds(t) AS made")
    states = freshness.stage_states(parts)
    assert {r["stage"]: r["state"] for r in states.collect()} == {"one": "fresh", "two": "stale", "three": "missing", "check": "gate"}
    order = ["one", "two", "three", "check"]
    runs = lambda **k: {r["stage"] for r in freshness.to_run(states, order, **k).filter("runs").collect()}
    assert runs() == {"two", "three", "check"} and runs(force=True) == set(order) and runs(only={"one"}) == set() and runs(first="three", skip={"check"}) == {"three"}
    with pytest.raises(ValueError):
        runs(only={"none"})
    (tmp_path / "a.bin").write_bytes(b"xyz")
    assert [(r["length"], r["made"] is not None) for r in freshness.listing(spark, str(tmp_path)).collect()] == [(3, True)]


def test_raster_in_bands(spark, tmp_path):
    z = np.random.default_rng(3).integers(-5, 900, (11, 7)).astype("<i2")
    (tmp_path / "dem.raw").write_bytes(z.tobytes())
    spark.dataSource.register(files.RawRaster)
    reader = spark.read.format("geolith_raster").option("width", 7).option("band", 4)
    got = reader.option("height", 11).load(str(tmp_path / "dem.raw"))
    assert got.rdd.getNumPartitions() == 3
    assert {(r["i"], r["j"]): r["z"] for r in got.collect()} == {(i, j): max(int(z[i, j]), 0) for i in range(11) for j in range(7)}
    with pytest.raises(Exception, match="samples"):
        reader.option("height", 12).load(str(tmp_path / "dem.raw")).count()
