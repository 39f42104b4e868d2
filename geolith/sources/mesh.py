"""Models of several textured objects that share one pool of vertices and indices.

A model is two relations: objects (file, place, name, texture, material) and corners (file, object, kind, place, ...). Offsets in
the pool are running sums over them; only the bytes of one file are put together by a function.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geolith.operators.ranking import exclusive_sum

#: Fixed layout: magic, three big-endian words (0, n, n), the objects, then vertices of eight floats and indices.
MAGIC, VERTEX, SEPARATOR = b"C3D\x01", np.dtype("<f4"), b"\0"
VERTEX_FLOATS, MATERIAL_FLOATS = 8, 6

OBJECTS = "path string, place int, name string, texture string, first_vertex int, vertices int, first_index int, indices int"


def offsets(sizes: DataFrame) -> DataFrame:
    """Adds first_vertex and first_index to (file, place, vertices, indices): where each object's part of the pool begins."""
    return sizes.withColumns({"first_vertex": exclusive_sum("vertices", "file", "place"), "first_index": exclusive_sum("indices", "file", "place")})


def encode(objects: list[tuple[str, str, np.ndarray, np.ndarray, list[float]]], order: list[int] | None = None) -> bytes:
    """A file of objects (name, texture, vertices n x 8, indices into its own vertices, material); `order` is that of the objects' parts in the pool, if it isn't theirs."""
    n = len(objects)
    out, place = [MAGIC, struct.pack(">3i", 0, n, n)], {}
    first_vertex = first_index = 0
    for k in order or range(n):
        place[k] = first_vertex, first_index
        first_vertex, first_index = first_vertex + len(objects[k][2]), first_index + len(objects[k][3])
    for k, (name, texture, v, i, material) in enumerate(objects):
        if len(i) and not 0 <= int(i.min()) <= int(i.max()) < len(v):
            raise ValueError(f"an index of {name} is out of range")
        if len(material) != MATERIAL_FLOATS or len(texture.encode("latin-1")) > 255:
            raise ValueError(f"material or texture of {name} does not fit")
        title, skin = name.encode("latin-1"), texture.encode("latin-1")
        out += [struct.pack(">i", len(title)), title, struct.pack("<4iB", place[k][0], len(v), place[k][1], len(i), len(skin)), skin, struct.pack("<6f", *material), SEPARATOR * (k < n - 1)]
    pooled = order or range(n)
    vertices = [objects[k][2].astype(VERTEX).tobytes() for k in pooled]
    indices = [(objects[k][3].astype("<i4") + place[k][0]).astype("<i4").tobytes() for k in pooled]
    return b"".join([*out, struct.pack("<2i", 0, first_vertex), *vertices, struct.pack("<i", first_index), *indices])


def find_pool(content: bytes) -> tuple[int, int, int]:
    """(start, vertices, indices) of the pool: a word 0, the number of vertices, these, the number of indices, and these up to the file's very end.

    All places are tried at once, for each of the four ways that words may lie in the bytes; the pool's parts are whole words, so its end
    is read from the same words.
    """
    n = len(content)
    found = []
    for shift in range(4):
        words = np.frombuffer(content, "<i4", (n - shift) // 4, shift)
        k = np.flatnonzero(words[:-2] == 0) if len(words) > 2 else np.zeros(0, np.int64)
        many = words[k + 1].astype(np.int64)
        after = k + 2 + VERTEX_FLOATS * many
        fits = (many >= 0) & (after < len(words))
        k, many, after = k[fits], many[fits], after[fits]
        last = words[after].astype(np.int64)
        ends = (last >= 0) & (shift + 4 * (after + 1 + last) == n)
        found += [(shift + 4 * int(a), int(v), int(i)) for a, v, i in zip(k[ends], many[ends], last[ends], strict=True) if shift + 4 * a >= len(MAGIC) + 12]
    # an empty pool looks like a row of zeros, so one that holds something goes first
    best = min((f for f in found if f[1] and f[2]), default=min(found, default=None))
    if best is None:
        raise ValueError("the size differs from the header's")
    return best


def _record(content: bytes, at: int, pool: tuple[int, int, int]) -> tuple[tuple, int] | None:
    """The object whose record stands at `at`, and where its texture's name ends; None if no such record can stand there."""
    if at + 21 > pool[0]:
        return None
    (size,) = struct.unpack_from(">i", content, at)
    if not 0 < size <= 255 or at + 21 + size > pool[0]:
        return None
    name = content[at + 4 : at + 4 + size]
    first_vertex, vertices, first_index, indices, skin = struct.unpack_from("<4iB", content, at + 4 + size)
    end = at + 21 + size + skin
    texture = content[end - skin : end]
    inside = 0 <= first_vertex <= first_vertex + vertices <= pool[1] and 0 <= first_index <= first_index + indices <= pool[2] and vertices >= 0 and indices >= 0
    if not inside or end > pool[0] or min(name + texture) < 32:
        return None
    return (name.decode("latin-1"), texture.decode("latin-1"), first_vertex, vertices, first_index, indices), end


def decode(content: bytes) -> tuple[list[tuple[str, str, int, int, int, int]], np.ndarray, np.ndarray]:
    """Objects (name, texture, first vertex, vertices, first index, indices), the vertices and the indices of a file.

    The pool is found by its own lengths, so that odd records before it do no harm: a record that isn't where the one before ends is
    looked for up to the pool.
    """
    if not content.startswith(MAGIC) or len(content) < len(MAGIC) + 24:
        raise ValueError("no model")
    _, n, _ = struct.unpack_from(">3i", content, len(MAGIC))
    pool = find_pool(content)
    at, found = len(MAGIC) + 12, []
    for k in range(n):
        held = next((r for q in range(at, pool[0]) if (r := _record(content, q, pool))), None)
        if held is None:
            raise ValueError(f"object {k} of {n} is not there")
        found.append(held[0])
        at = held[1] + 4 * MATERIAL_FLOATS + 1
    vertices = np.frombuffer(content, VERTEX, pool[1] * VERTEX_FLOATS, pool[0] + 8).reshape(-1, VERTEX_FLOATS)
    return found, vertices, np.frombuffer(content, "<i4", pool[2], pool[0] + 12 + vertices.nbytes)


def encoded(models: DataFrame) -> DataFrame:
    """(path, content) of a file for each path of (path, place, name, texture, ring, height): each row is an object, walls over a convex ring and a flat roof.

    Objects stand in the order of place. A file is put together in one task, which holds its objects.
    """

    def write(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        shapes = [prism([(p["x"], p["y"]) for p in r["ring"]], r["height"]) for r in rows]
        content = encode([(r["name"], r["texture"], v, i, [1.0] * MATERIAL_FLOATS) for r, (v, i) in zip(rows, shapes, strict=True)])
        return pa.table({"path": [rows[0]["path"]], "content": pa.array([content], pa.binary())})

    return models.select("path", "place", "name", "texture", "ring", "height").groupBy("path").applyInArrow(write, "path string, content binary")


def objects(files: DataFrame) -> DataFrame:
    """OBJECTS of each file of (path, content)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = [(path, k, *o) for k, o in enumerate(decode(content.as_py())[0])]
                kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), *[pa.int32()] * 4]
                columns = zip(*rows, strict=True) if rows else [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in OBJECTS.split(", ")])

    return files.select("path", "content").mapInArrow(read, OBJECTS)


def triangles(files: DataFrame) -> DataFrame:
    """(path, triangle, corner, vertex, x, y, z) of each corner of each triangle."""
    schema = "path string, triangle int, corner int, vertex int, x float, y float, z float"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                _, vertices, indices = decode(content.as_py())
                k = np.arange(len(indices), dtype=np.int32)
                corners = [np.ascontiguousarray(vertices[indices, c]) for c in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(k)), pa.array(k // 3), pa.array(k % 3), pa.array(indices), *map(pa.array, corners)], ["path", "triangle", "corner", "vertex", "x", "y", "z"])

    return files.select("path", "content").mapInArrow(read, schema)


def surface_area(corners: DataFrame) -> DataFrame:
    """(path, triangles, area) of the triangles of each file."""
    at = lambda c, k: F.max(F.when(F.col("corner") == k, F.col(c).cast("double")))
    t = corners.groupBy("path", "triangle").agg(*[(at(c, k) - at(c, 0)).alias(f"{c}{k}") for c in "xyz" for k in (1, 2)])
    cross = [F.col(f"{a}1") * F.col(f"{b}2") - F.col(f"{b}1") * F.col(f"{a}2") for a, b in ("yz", "zx", "xy")]
    return t.groupBy("path").agg(F.count(F.lit(1)).alias("triangles"), F.sum(F.sqrt(sum(c * c for c in cross)) / 2).alias("area"))


def prism(ring: list[tuple[float, float]], height: float) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and indices of walls over a ring and a flat roof; the roof is a fan, for convex rings."""
    n = len(ring)
    base = np.zeros((2 * n, VERTEX_FLOATS))
    base[:n, :2] = base[n:, :2] = ring
    base[n:, 2] = height
    k = np.arange(n)
    after = (k + 1) % n
    walls = np.stack([k, after, after + n, k, after + n, k + n], 1).ravel()
    roof = np.stack([np.full(n - 2, n), np.arange(n + 1, 2 * n - 1), np.arange(n + 2, 2 * n)], 1).ravel()
    return base, np.concatenate([walls, roof])
