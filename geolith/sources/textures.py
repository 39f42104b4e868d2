"""Block-compressed textures: blocks of 4 x 4 pixels with two end colours and two bits a pixel, as relations of pixels."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.session import importable
from geolith.sources import store

# Fixed values of the format: the header's size, and of each kind the bytes a block and where its colours stand in it.
HEADER, KINDS = 128, {b"DXT1": (8, 0), b"DXT3": (16, 8)}


def _rgb(c: np.ndarray) -> np.ndarray:
    """Red, green and blue from 0 to 255 of colours of 5, 6 and 5 bits, whose first bits fill up the last ones."""
    r, g, b = c >> 11, c >> 5 & 63, c & 31
    return np.stack([r << 3 | r >> 2, g << 2 | g >> 4, b << 3 | b >> 2], -1)


def decode_blocks(blocks: np.ndarray, kind: bytes = b"DXT1") -> np.ndarray:
    """(n, 16, 4): red, green, blue and alpha of the pixels, row by row, of blocks given as (n, bytes a block).

    Where the first colour is the greater one, the two between are thirds of the way; else, in the kind without alpha of its own, the third is the
    middle and the fourth is black and transparent.
    """
    _, at = KINDS[kind]
    ends = np.ascontiguousarray(blocks[:, at : at + 4]).view("<u2").astype(np.int32)
    a, b = _rgb(ends[:, 0]), _rgb(ends[:, 1])
    four = (ends[:, 0] > ends[:, 1])[:, None] | (kind != b"DXT1")
    table = np.stack([a, b, np.where(four, (2 * a + b) // 3, (a + b) // 2), np.where(four, (a + 2 * b) // 3, 0)], 1)
    bits = np.ascontiguousarray(blocks[:, at + 4 : at + 8]).view("<u4")
    index = (bits >> np.arange(0, 32, 2, dtype=np.uint32)) & 3
    out = np.empty((len(blocks), 16, 4), np.uint8)
    out[..., :3] = np.take_along_axis(table, index[..., None].astype(np.int64), 1)
    if kind == b"DXT1":
        out[..., 3] = np.where(~four & (index == 3), 0, 255)
    else:
        alpha = np.ascontiguousarray(blocks[:, :8]).view("<u8")
        out[..., 3] = (alpha >> np.arange(0, 64, 4, dtype=np.uint64) & np.uint64(15)) * np.uint64(17)
    return out


def read_header(data: bytes) -> tuple[int, int, bytes]:
    """(height, width, kind)."""
    if data[:4] != b"DDS " or len(data) < HEADER or data[84:88] not in KINDS:
        raise ValueError("no texture of a kind that can be read")
    return *struct.unpack_from("<II", data, 12), data[84:88]


def pixels(spark: SparkSession, path: str, rows: int = 64) -> DataFrame:
    """(path, i, j, r, g, b, a) of the pixels of a texture, or of all .dds files below a folder; each task decodes `rows` rows of blocks.

    Only the first image counts, not the smaller ones after it. A file that is too short for its size is an error; sides need not be multiples of four.
    """
    importable(spark)
    spans = []
    for name in store.files_below(path, (".dds",)):
        height, width, kind = read_header(store.read_range(name, 0, HEADER))
        each, down = KINDS[kind][0] * -(-width // 4), -(-height // 4)
        if store.size_of(name) < HEADER + each * down:
            raise ValueError(f"{name} is too short for {height} x {width} pixels")
        spans += [(name, at, min(rows, down - at), height, width, kind.decode()) for at in range(0, down, rows)]
    planned = spark.createDataFrame(spans, "path string, at int, n int, height int, width int, kind string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                kind, across = s["kind"].encode(), -(-s["width"] // 4)
                size = KINDS[kind][0]
                data = np.frombuffer(store.read_range(s["path"], HEADER + s["at"] * across * size, s["n"] * across * size), np.uint8)
                for k, row in enumerate(data.reshape(s["n"], across, size)):
                    image = decode_blocks(row, kind).reshape(across, 4, 4, 4).transpose(1, 0, 2, 3).reshape(4, across * 4, 4)
                    first = 4 * (s["at"] + k)
                    image = image[: s["height"] - first, : s["width"]]
                    i, j = np.indices(image.shape[:2], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([s["path"]] * i.size), pa.array((i + first).ravel()), pa.array(j.ravel()), *[pa.array(image[..., c].ravel().astype(np.int32)) for c in range(4)]], ["path", "i", "j", "r", "g", "b", "a"])

    return planned.repartition(max(1, len(spans))).mapInArrow(decode, "path string, i int, j int, r int, g int, b int, a int")


def block_pixels(rows: DataFrame, block: str) -> DataFrame:
    """The columns of rows but `block`, eight bytes of colours, with (i, j, r, g, b, a) of its sixteen pixels."""
    kept = [c for c in rows.columns if c != block]
    schema = rows.select(*kept).schema
    for c in ("i", "j", "r", "g", "b", "a"):
        schema = schema.add(c, "integer")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            out = decode_blocks(np.frombuffer(b"".join(batch.column(block).to_pylist()), np.uint8).reshape(n, 8)).reshape(-1, 4).astype(np.int32)
            each = pa.array(np.repeat(np.arange(n), 16))
            i, j = (np.tile(v, n).astype(np.int32) for v in np.divmod(np.arange(16), 4))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(each) for c in kept], pa.array(i), pa.array(j), *[pa.array(out[:, c].copy()) for c in range(4)]], schema.names)

    return rows.filter(F.octet_length(block) == 8).select(*kept, block).mapInArrow(decode, schema)
