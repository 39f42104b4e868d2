"""Single-band GeoTIFF rasters: a source that plans no strip or tile outside of a filter, and an encoder with overviews."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from geolith.session import importable
from geolith.sources import store

# Fixed values of the format: tags, field types (code: size, struct letter) and compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, BANDS, STRIP_ROWS, STRIP_BYTES, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317
SUBFILE, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SAMPLE_FORMAT, SCALE, TIEPOINT, MATRIX, KEYS, NODATA = 254, 322, 323, 324, 325, 339, 33550, 33922, 34264, 34735, 42113
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
PROJECTED_CRS, MODEL_TYPE, RASTER_TYPE = 3072, 1024, 1025


@dataclass(frozen=True)
class Header:
    """One image of a file: its size, how cells are stored, where blocks are, and where it lies.

    affine is (a, b, c, d, e, f): x = a * j + b * i + c and y = d * j + e * i + f for the corner of cell (i, j).
    """

    width: int
    height: int
    dtype: str
    compression: int
    predictor: int
    block: tuple[int, int]  # rows and columns
    tiled: bool
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    affine: tuple[float, float, float, float, float, float]
    nodata: float | None

    def blocks(self) -> Iterator[tuple[int, int, int, int]]:
        """(number, first row, first column, rows that are there) of each block."""
        across = -(-self.width // self.block[1])
        for n in range(len(self.offsets)):
            i, j = n // across * self.block[0], n % across * self.block[1]
            yield n, i, j, min(self.block[0], self.height - i)

    def decode(self, data: bytes, rows: int) -> np.ndarray:
        """The cells of a block; a strip has only the rows that are there."""
        if self.compression in (DEFLATE, OLD_DEFLATE):
            data = zlib.decompress(data)
        shape = (self.block[0] if self.tiled else rows, self.block[1])
        out = np.frombuffer(data, self.dtype, shape[0] * shape[1]).reshape(shape)
        if self.predictor == 2:
            out = np.cumsum(out, axis=1, dtype=out.dtype)
        return out[:rows]


def _fields(read: Callable[[int, int], bytes], order: str, big: bool, at: int) -> tuple[dict[int, tuple], int]:
    """The fields of the directory at `at`, and where the next one is."""
    head, entry, count = ("Q", 20, 8) if big else ("H", 12, 4)
    n = struct.unpack(order + head, read(at, struct.calcsize(order + head)))[0]
    begin = at + struct.calcsize(order + head)
    raw = read(begin, n * entry + count)
    out: dict[int, tuple] = {}
    for k in range(n):
        tag, kind = struct.unpack_from(order + "HH", raw, k * entry)
        many = struct.unpack_from(order + ("Q" if big else "I"), raw, k * entry + 4)[0]
        if kind not in TYPES:
            continue
        size, letter = TYPES[kind]
        inline = raw[k * entry + (12 if big else 8) : (k + 1) * entry]
        data = inline[: size * many] if size * many <= len(inline) else read(struct.unpack(order + ("Q" if big else "I"), inline)[0], size * many)
        out[tag] = (data.rstrip(b"\0").decode("ascii", "replace"),) if kind == 2 else struct.unpack(f"{order}{many}{letter}", data)
    return out, struct.unpack_from(order + ("Q" if big else "I"), raw, n * entry)[0]


def read_header(read: Callable[[int, int], bytes], level: int = 0) -> Header:
    """The header of the image, or of its overview number `level`, by read(at, size)."""
    start = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    version = struct.unpack(f"{order}H", start[2:4])[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), start, 8 if big else 4)[0]
    found, at = _fields(read, order, big, at)
    first = found
    for _ in range(level):
        if not at:
            raise ValueError(f"there is no overview {level}")
        found, at = _fields(read, order, big, at)
    if found.get(BANDS, (1,))[0] != 1:
        raise ValueError("only files of a single band can be read")
    compression, predictor = found.get(COMPRESSION, (PLAIN,))[0], found.get(PREDICTOR, (1,))[0]
    if compression not in (PLAIN, DEFLATE, OLD_DEFLATE) or predictor not in (1, 2):
        raise ValueError(f"compression {compression} with predictor {predictor} can't be read")
    kind = {1: "u", 2: "i", 3: "f"}[found.get(SAMPLE_FORMAT, (1,))[0]]
    width, height, tiled = found[WIDTH][0], found[HEIGHT][0], TILES in found
    block = (found[TILE_HEIGHT][0], found[TILE_WIDTH][0]) if tiled else (min(found.get(STRIP_ROWS, (height,))[0], height), width)
    if MATRIX in first:
        m = first[MATRIX]
        affine = (m[0], m[1], m[3], m[4], m[5], m[7])
    elif SCALE in first and TIEPOINT in first:
        (sx, sy, *_), (pj, pi, _, px, py, *_) = first[SCALE], first[TIEPOINT]
        affine = (sx, 0.0, px - pj * sx, 0.0, -sy, py + pi * sy)
    else:
        affine = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    by_x, by_y = first[WIDTH][0] / width, first[HEIGHT][0] / height  # an overview's cells are larger
    affine = (affine[0] * by_x, affine[1] * by_y, affine[2], affine[3] * by_x, affine[4] * by_y, affine[5])
    nodata = first.get(NODATA, ("",))[0].strip()
    return Header(width, height, f"{order}{kind}{found.get(BITS, (1,))[0] // 8}", compression, predictor, block, tiled, found[TILES if tiled else STRIPS], found[TILE_BYTES if tiled else STRIP_BYTES], affine, float(nodata) if nodata else None)


def encode(cells: np.ndarray, affine: tuple[float, ...], epsg: int, nodata: float | None = None, tile: int | None = None, rows: int = 64, compress: bool = False, overviews: int = 0) -> bytes:
    """The file of a grid that lies straight (affine with b = d = 0), in strips of `rows` or tiles, with overviews of half the size each, by means of four cells."""
    if affine[1] or affine[3]:
        raise ValueError("a turned grid has no scale and tie point")
    cells = cells.astype(cells.dtype.newbyteorder("<"))
    images = [cells]
    for _ in range(overviews):
        a = images[-1].astype(np.float64)
        a = np.pad(a, ((0, a.shape[0] % 2), (0, a.shape[1] % 2)), mode="edge")
        mean = a.reshape(a.shape[0] // 2, 2, a.shape[1] // 2, 2).mean((1, 3))
        images.append((np.rint(mean) if cells.dtype.kind in "iu" else mean).astype(cells.dtype))
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4  # where the place of the next directory goes
    for level, image in enumerate(images):
        height, width = image.shape
        blocks = []
        if tile:
            full = np.zeros((-(-height // tile) * tile, -(-width // tile) * tile), image.dtype)
            full[:height, :width] = image
            blocks = [full[i : i + tile, j : j + tile].tobytes() for i in range(0, height, tile) for j in range(0, width, tile)]
        else:
            blocks = [image[i : i + rows].tobytes() for i in range(0, height, rows)]
        blocks = [zlib.compress(b) for b in blocks] if compress else blocks
        places = []
        for b in blocks:
            places.append(len(out))
            out += b + b"\0" * (len(b) % 2)
        sizes = [len(b) for b in blocks]
        fields: list[tuple[int, int, tuple]] = [
            (SUBFILE, 4, (int(level > 0),)), (WIDTH, 4, (width,)), (HEIGHT, 4, (height,)), (BITS, 3, (8 * image.dtype.itemsize,)), (COMPRESSION, 3, (DEFLATE if compress else PLAIN,)), (PHOTOMETRIC, 3, (1,)), (BANDS, 3, (1,)),
            (SAMPLE_FORMAT, 3, ({"u": 1, "i": 2, "f": 3}[image.dtype.kind],)),
        ]
        fields += [(TILE_WIDTH, 4, (tile,)), (TILE_HEIGHT, 4, (tile,)), (TILES, 4, tuple(places)), (TILE_BYTES, 4, tuple(sizes))] if tile else [(STRIPS, 4, tuple(places)), (STRIP_ROWS, 4, (rows,)), (STRIP_BYTES, 4, tuple(sizes))]
        if not level:
            fields += [(SCALE, 12, (affine[0], -affine[4], 0.0)), (TIEPOINT, 12, (0.0, 0.0, 0.0, affine[2], affine[5], 0.0)), (KEYS, 3, (1, 1, 0, 3, MODEL_TYPE, 0, 1, 1, RASTER_TYPE, 0, 1, 1, PROJECTED_CRS, 0, 1, epsg))]
            if nodata is not None:
                fields.append((NODATA, 2, (f"{nodata:g}\0".encode(),)))
        fields.sort()
        struct.pack_into("<I", out, link, len(out))
        at = len(out)
        later = at + 2 + 12 * len(fields) + 4
        entries, tail = b"", b""
        for tag, kind, values in fields:
            data = values[0] if kind == 2 else struct.pack(f"<{len(values)}{TYPES[kind][1]}", *values)
            many = len(data) // TYPES[kind][0]
            if len(data) > 4:
                entries += struct.pack("<HHII", tag, kind, many, later + len(tail))
                tail += data + b"\0" * (len(data) % 2)
            else:
                entries += struct.pack("<HHI", tag, kind, many) + data.ljust(4, b"\0")
        out += struct.pack("<H", len(fields)) + entries + struct.pack("<I", 0) + tail
        link = at + 2 + 12 * len(fields)
    return bytes(out)


class GeoTiff(DataSource):
    """format("geolith_tiff"): (path, i, j, x, y, z) of the cells of single-band GeoTIFF files; x and y are the cell's middle, cells without data have a null z.

    Options: path (a file, or a folder with .tif files below it; of any store that pyarrow knows), level (0, or the number of an overview), cells (about so many a
    partition, 1048576 by default). Spark asks for spark.sql.python.filterPushdown.enabled, as comparisons of i and j with constants
    are pushed down: strips and tiles outside of them are not planned. geotiff() sets it. Headers are read by the driver: for few large files, not many small ones.
    """

    @classmethod
    def name(cls) -> str:
        return "geolith_tiff"

    def schema(self) -> str:
        return "path string, i int, j int, x double, y double, z double"

    def reader(self, schema) -> DataSourceReader:
        return TiffReader(self.options["path"], int(self.options.get("level", "0")), int(self.options.get("cells", str(1 << 20))))


def geotiff(spark: SparkSession, path: str, **options) -> DataFrame:
    """The cells of the files; registers the source and lets Spark push filters down to Python sources."""
    importable(spark)
    spark.dataSource.register(GeoTiff)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(GeoTiff.name()).option("path", path).options(**options).load()


class TiffReader(DataSourceReader):
    def __init__(self, path: str, level: int, cells: int) -> None:
        self.path, self.level, self.cells = path, level, cells
        self.low, self.high = {"i": 0, "j": 0}, {"i": float("inf"), "j": float("inf")}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) in (("i",), ("j",)):
                axis, value = f.attribute[0], getattr(f, "value", None)
                if isinstance(f, In):
                    held = [v for v in f.value if v is not None]
                    value = held
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and value is not None:
                    self.low[axis] = max(self.low[axis], value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)) and value is not None:
                    self.high[axis] = min(self.high[axis], value - isinstance(f, LessThan))
                if isinstance(f, In) and value:
                    self.low[axis], self.high[axis] = max(self.low[axis], min(value)), min(self.high[axis], max(value))
            yield f  # a block holds other cells too: Spark filters its rows

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in store.files_below(self.path, (".tif", ".tiff")):
            header = read_header(lambda at, size, path=path: store.read_range(path, at, size), self.level)
            held: list[tuple[int, int, int, int]] = []
            for n, i, j, rows in header.blocks():
                if i + rows > self.low["i"] and i <= self.high["i"] and j + header.block[1] > self.low["j"] and j <= self.high["j"]:
                    held.append((n, i, j, rows))
                    if len(held) * header.block[0] * header.block[1] >= self.cells:
                        out.append(InputPartition((path, header, held)))
                        held = []
            if held:
                out.append(InputPartition((path, header, held)))
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, header, blocks = partition.value
        a, b, c, d, e, f = header.affine
        for n, i0, j0, rows in blocks:
            z = header.decode(store.read_range(path, header.offsets[n], header.sizes[n]), rows)[:, : header.width - j0].astype(np.float64)
            i, j = np.indices(z.shape, dtype=np.int32)
            i, j, z = (i + i0).ravel().astype(np.int32), (j + j0).ravel().astype(np.int32), z.ravel()
            none = np.isnan(z) | (z == header.nodata if header.nodata is not None else False)
            x, y = a * (j + 0.5) + b * (i + 0.5) + c, d * (j + 0.5) + e * (i + 0.5) + f
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(z)), pa.array(i), pa.array(j), pa.array(x), pa.array(y), pa.array(z, mask=none)], ["path", "i", "j", "x", "y", "z"])
