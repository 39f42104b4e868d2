"""Binary files as relations: read through Spark's binaryFile source, encoded as rows of (name, content)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from geolith.sources import formats
from geolith.sources.store import located, read_range, size_of

OBJECT_ROWS = "x float, y float, z float, scale float, heading float, name string"
AIRPORT_ROWS = "name string, lat float, lon float, elevation float, direction int, length int, width int, frequency float"
_LAYOUTS = {"object": (formats.OBJECT, OBJECT_ROWS), "airport": (formats.AIRPORT, AIRPORT_ROWS)}


def binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, content) of the files below a folder of any store that Spark reads."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")


def listing(spark: SparkSession, path: str, pattern: str, least: int = 100) -> DataFrame:
    """(path, length, modified, x, y) of files whose name matches pattern with two whole numbers, of at least `least` bytes."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    at = [F.regexp_extract("path", pattern, k).try_cast("int") for k in (1, 2)]
    return rows.filter(F.col("length") >= least).withColumns({"x": at[0], "y": at[1]}).filter("x IS NOT NULL AND y IS NOT NULL")


def encoded_records(rows: DataFrame, kind: str) -> DataFrame:
    """A `record` for each row, as the layout's bytes."""
    layout, schema = _LAYOUTS[kind]
    fields = [f.split()[0] for f in schema.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = formats.records(layout, {c: (batch[c].to_pylist() if c == "name" else batch[c].to_numpy(zero_copy_only=False)) for c in fields})
            if kind == "airport":
                out["kind"] = formats.AIRPORT_KIND
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in batch.schema.names], pa.array([r.tobytes() for r in out], pa.binary())], [*batch.schema.names, "record"])

    return rows.mapInArrow(encode, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", record binary")


def decoded_records(files: DataFrame, kind: str) -> DataFrame:
    """The rows in the `content` of each file, with its `path` and their number there."""
    layout, schema = _LAYOUTS[kind]
    fields = [f.split()[0] for f in schema.split(", ")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = formats.decode_records(layout, content.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(np.arange(len(rows))), *[pa.array(formats.names(rows) if c == "name" else np.ascontiguousarray(rows[c])) for c in fields]], ["path", "place", *fields])

    return files.select("path", "content").mapInArrow(decode, f"path string, place long, {schema}")


def decoded_grids(files: DataFrame, decode: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(path, i, j, z) of each cell of each file's grid."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                grid = decode(content.as_py())
                for i in range(0, len(grid), 256):  # so many rows at a time
                    part = grid[i : i + 256]
                    a, b = np.indices(part.shape)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * part.size), pa.array((a + i).ravel().astype(np.int32)), pa.array(b.ravel().astype(np.int32)), pa.array(part.ravel().astype(np.int32))], ["path", "i", "j", "z"])

    return files.select("path", "content").mapInArrow(cells, "path string, i int, j int, z int")


def encoded_grids(cells: DataFrame, side: int, encode: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(c, r, content): a square file for each patch from (c, r, i, j, z). A patch has side x side cells, all of them."""

    def patch(key: tuple, table: pa.Table) -> pa.Table:
        if table.num_rows != side * side:
            raise ValueError(f"patch {key[0]}, {key[1]} has {table.num_rows} cells")
        grid = np.zeros((side, side), np.int64)
        grid[table["i"].to_numpy(), table["j"].to_numpy()] = table["z"].to_numpy()
        return pa.table({"c": pa.array([key[0].as_py()], pa.int32()), "r": pa.array([key[1].as_py()], pa.int32()), "content": pa.array([encode(grid)], pa.binary())})

    return cells.groupBy("c", "r").applyInArrow(patch, "c int, r int, content binary")


class FileSink(DataSource):
    """format("geolith_files"): rows of (name, content) become files of a folder of any store that pyarrow knows.

    A file is written under another name and takes its own when the job commits, so a lost executor leaves
    none half written. Option overwrite = false keeps files that are there. With an option backup, a folder, a file that is overwritten for the first time is
    kept there under its name: later ones leave the first backup as it is.
    """

    @classmethod
    def name(cls) -> str:
        return "geolith_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _FileWriter(self.options["path"], self.options.get("overwrite", "true").lower() != "false", self.options.get("backup"))


class _FileWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, backup: str | None) -> None:
        self.path, self.overwrite, self.backup = path.rstrip("/"), overwrite, backup and backup.rstrip("/")

    def write(self, iterator) -> WriterCommitMessage:
        import uuid

        done = []
        store, root = located(self.path)
        for row in iterator:
            final = f"{root}/{row['name']}"
            store.create_dir(final.rpartition("/")[0])
            draft = f"{final}.{uuid.uuid4().hex}.part"
            with store.open_output_stream(draft) as f:
                f.write(row["content"])
            done.append((draft, row["name"]))
        return _Done(done)

    def commit(self, messages: list) -> None:
        from pyarrow.fs import FileType

        store, root = located(self.path)
        there = lambda s, path: s.get_file_info(path).type != FileType.NotFound
        for draft, name in (x for m in messages if m for x in m.files):
            final = f"{root}/{name}"
            if there(store, final) and not self.overwrite:
                store.delete_file(draft)
                continue
            if self.backup and there(store, final):
                kept, folder = located(self.backup)
                first = f"{folder}/{name}"
                if not there(kept, first):
                    kept.create_dir(first.rpartition("/")[0])
                    with store.open_input_stream(final) as old, kept.open_output_stream(f"{first}.part") as new:
                        while part := old.read(1 << 20):
                            new.write(part)
                    kept.move(f"{first}.part", first)
            store.move(draft, final)

    def abort(self, messages: list) -> None:
        store, _ = located(self.path)
        for draft, _name in (x for m in messages if m for x in m.files):
            store.delete_file(draft)


class _Done(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str]]) -> None:
        self.files = files


class RawRaster(DataSource):
    """format("geolith_raster"): a headerless raster of 16-bit heights, read in bands of rows.

    Options: path (of any store that pyarrow knows), width, height, band (rows a task). Values below 0
    become 0; a file of another size is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "geolith_raster"

    def schema(self) -> str:
        return "i int, j int, z int"

    def reader(self, schema) -> DataSourceReader:
        o = self.options
        return _BandReader(o["path"], int(o["width"]), int(o["height"]), int(o.get("band", "256")))


class _BandReader(DataSourceReader):
    def __init__(self, path: str, width: int, height: int, band: int) -> None:
        self.path, self.width, self.height, self.band = path, width, height, band

    def partitions(self) -> list[InputPartition]:
        if (size := size_of(self.path)) != 2 * self.width * self.height:
            raise ValueError(f"{size // 2} samples are not {self.width} x {self.height}")
        return [InputPartition(row) for row in range(0, self.height, self.band)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        rows = min(self.band, self.height - partition.value)
        z = formats.decode_heights(read_range(self.path, 2 * self.width * partition.value, 2 * self.width * rows), self.width, rows)
        i, j = np.indices(z.shape, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array((i + partition.value).ravel()), pa.array(j.ravel()), pa.array(z.ravel().astype(np.int32))], ["i", "j", "z"])
