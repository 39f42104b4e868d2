"""Feature collections larger than a task: one JSON file is cut by byte ranges at its features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.functions import rings
from geolith.session import importable
from geolith.sources import store
from geolith.sources.text import polygon_ring

#: Bytes that a task reads.
SPLIT = 32 << 20
#: Brackets around the features: those of the collection and of its list.
AROUND = 2
FEATURE = "type STRING, properties MAP<STRING, STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"


def _escaped_first(path: str, at: int) -> bool:
    """Whether an odd number of backslashes stands before `at`."""
    look, n = 64, 0
    while at:
        before = store.read_range(path, max(0, at - look), min(look, at))
        n = len(before) - len(before.rstrip(b"\\"))
        if n < len(before) or look >= at:
            break
        look *= 4
    return n % 2 == 1


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes."""
    back = data == 92
    at = np.arange(len(data))
    last = np.maximum.accumulate(np.where(back, -1, at)) if len(data) else at  # of other bytes, before or at each place
    before = np.concatenate([[-1], last[:-1]]) if len(data) else at
    run = at - 1 - before + np.where(before < 0, int(escaped), 0)
    return (data == 34) & (run % 2 == 0)


def _steps(data: np.ndarray) -> np.ndarray:
    return np.isin(data, [123, 91]).astype(np.int64) - np.isin(data, [125, 93])


def summary(data: bytes, escaped: bool) -> tuple[int, int, int]:
    """(quotes mod 2, brackets that stay open if the range begins outside of a string, the same if it begins inside)."""
    raw = np.frombuffer(data, np.uint8)
    inside, steps = np.cumsum(_quotes(raw, escaped)) % 2 == 1, _steps(raw)
    return int(inside[-1]) if len(raw) else 0, int(steps[~inside].sum()), int(steps[inside].sum())


def features_in(data: bytes, size: int, escaped: bool, inside: bool, depth: int) -> tuple[list[tuple[int, int]], bool]:
    """(start, end) of the objects directly in the list that start in the first `size` bytes, and whether all of them end in the data."""
    raw = np.frombuffer(data, np.uint8)
    outside = np.cumsum(_quotes(raw, escaped)) % 2 == int(inside)
    steps = np.where(outside, _steps(raw), 0)
    after = depth + np.cumsum(steps)
    starts = np.flatnonzero((steps > 0) & (raw == 123) & (after == AROUND + 1))
    ends = np.flatnonzero((steps < 0) & (raw == 125) & (after == AROUND)) + 1
    starts = starts[starts < size]
    place = np.searchsorted(ends, starts, side="right")
    whole = bool(len(place) == 0 or place[-1] < len(ends))
    return [(int(s), int(ends[p])) for s, p in zip(starts, place, strict=True) if p < len(ends)], whole


def feature_texts(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, at, text) of each object in the list of a collection, with its place in the file; `path` is a file, or a folder with .geojson and .json files.

    A first job gives of each byte range how its brackets and quotes balance, for either state that it may begin in. From these few numbers the driver knows the
    state at each range's start; a second job cuts the objects that start in its range, and reads on for the last one.
    """
    importable(spark)
    spans = [(f, at, min(split, size - at)) for f in store.files_below(path, (".geojson", ".json")) for size in [store.size_of(f)] for at in range(0, size, split)]
    planned = spark.createDataFrame(spans, "path string, at long, size long").repartition(max(1, len(spans)), "path", "at")

    def balance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [summary(store.read_range(r["path"], r["at"], r["size"]), _escaped_first(r["path"], r["at"])) for r in rows]
            yield pa.RecordBatch.from_pydict({"path": [r["path"] for r in rows], "at": [r["at"] for r in rows], "quotes": [f[0] for f in found], "out": [f[1] for f in found], "ins": [f[2] for f in found]})

    held = {(r["path"], r["at"]): (r["quotes"], r["out"], r["ins"]) for r in planned.mapInArrow(balance, "path string, at long, quotes long, out long, ins long").collect()}
    known, inside, depth = [], False, 0
    for file, at, size in spans:
        if at == 0:
            inside, depth = False, 0
        known.append((file, at, size, inside, depth))
        quotes, out, ins = held[file, at]
        inside, depth = inside != bool(quotes), depth + (ins if inside else out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                more, escaped, end = 1 << 16, _escaped_first(r["path"], r["at"]), store.size_of(r["path"])
                while True:
                    data = store.read_range(r["path"], r["at"], min(r["size"] + more, end - r["at"]))
                    found, whole = features_in(data, r["size"], escaped, r["inside"], r["depth"])
                    if whole or r["at"] + len(data) >= end:
                        break
                    more *= 4
                yield pa.RecordBatch.from_pydict({"path": pa.array([r["path"]] * len(found), pa.string()), "at": pa.array([r["at"] + a for a, _ in found], pa.int64()), "text": pa.array([data[a:b].decode() for a, b in found], pa.string())})

    starts = spark.createDataFrame(known, "path string, at long, size long, inside boolean, depth long").repartition(max(1, len(known)), "path", "at")
    return starts.mapInArrow(cut, "path string, at long, text string")


def split_features(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, at, properties, kind, coordinates) of the features; coordinates as JSON text. Objects that are no features or have no geometry are left out."""
    rows = feature_texts(spark, path, split).select("path", "at", F.from_json("text", FEATURE).alias("f")).filter("f.type = 'Feature' AND f.geometry.type IS NOT NULL")
    return rows.select("path", "at", F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def loaded_polygons(features: DataFrame, project: Callable[[Column, Column], tuple[Column, Column]] | None = None) -> DataFrame:
    """Polygons with `ring`, their outer ring, projected while it is read; those whose ring has no three different points or no area are left out."""
    ring = polygon_ring(F.col("coordinates"))
    if project:
        ring = F.transform(ring, lambda p: rings.point(*project(p["x"], p["y"])))
    return features.filter("kind = 'Polygon'").withColumn("ring", F.explode(F.array(ring))).filter(rings.valid(F.col("ring")))
