"""Token ids in directly addressable codes (DAC), written as segments in document order.

An id is cut into chunks of LEVEL_BITS bits from its low end. Level k holds the k-th chunk of every id
that has one; a bitmap beside it says which of them go on to level k + 1, and a rank directory gives
the number of set bits before each block of the bitmap. Token i of a segment is read from chunk i of
level 0; while the bitmap's bit is set, the next chunk's place is that bit's rank. No block is decoded.

A segment is a file of its own: a header, the doc_ids and the places where their ids begin, then each level with its bitmap
and ranks. A catalogue in Parquet has one row for each segment. A token is read by byte ranges of one file: a few for
the document's place by bisection, three for each level. Files are written through pyarrow's file systems (mounted folders, HDFS
and object stores) under a name that no other attempt of the task has; only the catalogue's rows, which Spark commits, say
which files count. Texts are dealt out by ranges of doc_id and encoded there: to order ids in their place, they must be written first,
which takes more of the disk than the texts take.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.shared import Scratch, documents, no_shuffle_files, partitions, ready
from geolith.llm.tokens import encoder, end_mark

#: Bits of a chunk, of which codes of 16 bits have two at most; bits of a bitmap that a rank entry covers.
LEVEL_BITS, RANK_BLOCK = 8, 512
#: A segment closes after the document with which it reaches as many ids.
SEGMENT_IDS = 1 << 19
END_ID = 2
#: In segments, the id of documents whose doc_id is null; it sorts first, as null does.
NO_ID = int(np.iinfo(np.int64).min)

SEGMENT = "part int, segment int, file string, first_id long, last_id long, n_docs long, n_ids long"
_CATALOGUE = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("file", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def dac_encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunk levels, continuation bitmaps and rank directories of unsigned ids; nothing goes on from the last level, which has neither."""
    levels, bitmaps, ranks, rest = [], [], [], ids.astype(np.uint32)
    while True:
        levels.append((rest & ((1 << LEVEL_BITS) - 1)).astype(np.uint8).tobytes())
        more = rest >> LEVEL_BITS
        goes_on = more > 0
        packed = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(goes_on, np.arange(0, max(len(rest), 1), RANK_BLOCK), dtype=np.uint32) if len(rest) else np.zeros(0, np.uint32)
        bitmaps.append(packed.tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4").tobytes() if len(rest) else b"")
        rest = more[goes_on]
        if not len(rest):
            return levels, [*bitmaps[:-1], b""], [*ranks[:-1], b""]


class Dac:
    """The ids of a code that is in memory."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]) -> None:
        self.sections = [b"".join(x) for x in zip(levels, bitmaps, ranks, strict=True)]
        self.sizes = [len(x) for x in levels]

    def __len__(self) -> int:
        return self.sizes[0]

    def __getitem__(self, at: int) -> int:
        if not 0 <= at < len(self):
            raise IndexError(at)
        return read_code(lambda level, first, size: self.sections[level][first : first + size], self.sizes, at)

    def all(self) -> np.ndarray:
        """Every id in order, level by level from the last."""
        above = np.zeros(0, np.uint32)
        for section, n in zip(self.sections[::-1], self.sizes[::-1], strict=True):
            ids = np.frombuffer(section, np.uint8, n).astype(np.uint32)
            if len(section) > n:
                ids[np.unpackbits(np.frombuffer(section, np.uint8, -(-n // 8), n), count=n, bitorder="little").astype(bool)] |= above << LEVEL_BITS
            above = ids
        return above


def read_code(read: Callable[[int, int, int], bytes], sizes: list[int], at: int) -> int:
    """The id at place `at`, where read(level, first, size) gives bytes of a level's chunks, bitmap and ranks, which stand in that order."""
    value = 0
    for level, n in enumerate(sizes):
        value |= read(level, at, 1)[0] << (LEVEL_BITS * level)
        if level == len(sizes) - 1:
            break
        block, bitmap = at // RANK_BLOCK, n
        first = block * RANK_BLOCK // 8
        bits = int.from_bytes(read(level, bitmap + first, at // 8 - first + 1), "little")  # from the block's start to the place
        place = at - block * RANK_BLOCK
        if not bits >> place & 1:
            break
        before = int.from_bytes(read(level, bitmap + -(-n // 8) + 4 * block, 4), "little")
        at = before + (bits & ((1 << place) - 1)).bit_count()
    return value


#: Of a segment file: what it begins with, then as little-endian 64-bit numbers the documents, the levels and each level's size.
MAGIC = b"DACIDS01"


def segment_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment file: header, doc_ids, first place of each document and the end, then chunks, bitmap and ranks of each level."""
    levels, bitmaps, ranks = dac_encode(ids)
    header = np.array([len(doc_ids), len(levels), *map(len, levels)], "<i8").tobytes()
    places = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes()
    return b"".join([MAGIC, header, doc_ids.astype("<i8").tobytes(), places, *(x for level in zip(levels, bitmaps, ranks, strict=True) for x in level)])


class SegmentFile:
    """A segment file that is read by byte ranges."""

    def __init__(self, file: BinaryIO) -> None:
        self.file = file
        if self._at(0, 8) != MAGIC:
            raise ValueError("not a segment file")
        self.n_docs, n_levels = self._numbers(8, 2)
        self.sizes = self._numbers(24, n_levels)
        self.docs_at = 24 + 8 * n_levels
        at = self.docs_at + 16 * self.n_docs + 8
        self.levels_at = []
        for n in self.sizes:
            self.levels_at.append(at)
            at += n if len(self.levels_at) == n_levels else n + -(-n // 8) + 4 * -(-n // RANK_BLOCK)
        self.end = at

    def _at(self, first: int, size: int) -> bytes:
        self.file.seek(first)
        return self.file.read(size)

    def _numbers(self, first: int, n: int) -> list[int]:
        return np.frombuffer(self._at(first, 8 * n), "<i8").tolist()

    def place(self, doc_id: int) -> tuple[int, int] | None:
        """First and end place of the first document with this id, by bisection."""
        lo, hi = 0, self.n_docs
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self._numbers(self.docs_at + 8 * mid, 1)[0] < doc_id else (lo, mid)
        if lo == self.n_docs or self._numbers(self.docs_at + 8 * lo, 1)[0] != doc_id:
            return None
        first, end = self._numbers(self.docs_at + 8 * self.n_docs + 8 * lo, 2)
        return first, end

    def token(self, at: int) -> int:
        return read_code(lambda level, first, size: self._at(self.levels_at[level] + first, size), self.sizes, at)

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc_ids, first place of each and the end, ids)."""
        data = self._at(self.docs_at, self.end - self.docs_at)
        doc_ids = np.frombuffer(data, "<i8", self.n_docs)
        places = np.frombuffer(data, "<i8", self.n_docs + 1, 8 * self.n_docs)
        sections = [data[a - self.docs_at : b - self.docs_at] for a, b in zip(self.levels_at, [*self.levels_at[1:], self.end], strict=True)]
        code = Dac([x[:n] for x, n in zip(sections, self.sizes)], [x[n : n + -(-n // 8)] for x, n in zip(sections, self.sizes)], [x[n + -(-n // 8) :] for x, n in zip(sections, self.sizes)])
        return doc_ids, places, code.all()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a path or URI, and the path there."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), path.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(path)


def write_token_segments(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes (doc_id, text), end_id after each text, and writes segments in ascending order of doc_id below `path`.

    Null text counts as empty: the end id alone. Rows that share a doc_id stay apart, in the order of their
    texts' hashes; null doc_ids come first. A very long text is encoded whole and stays in one segment. Empty input writes no
    segment. Other columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, held, size = TaskContext.get().partitionId(), 0, [], 0
        code, end = encoder(tokenizer_path), end_mark(end_id)
        store, root = file_system(f"{path}/files")
        store.create_dir(root)

        def close() -> pa.RecordBatch:
            doc_ids = np.array([d for d, _ in held], np.int64)
            lengths = np.array([len(i) // 2 for _, i in held], np.int64)
            name = f"{part:06d}-{segment:06d}-{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(segment_bytes(doc_ids, lengths, np.frombuffer(b"".join(i for _, i in held), "<u2")))
            return pa.RecordBatch.from_pylist([{"part": part, "segment": segment, "file": name, "first_id": int(doc_ids[0]), "last_id": int(doc_ids[-1]), "n_docs": len(held), "n_ids": int(lengths.sum())}], schema=_CATALOGUE)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                held.append((NO_ID if doc_id is None else doc_id, code.ids(text.as_py()) + end))
                size += len(held[-1][1]) // 2
                if size >= segment_ids:
                    yield close()
                    segment, held, size = segment + 1, [], 0
        if held:
            yield close()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")).repartitionByRange(partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    with no_shuffle_files(spark):
        ordered.select("doc_id", "text").mapInArrow(write, SEGMENT).write.parquet(f"{path}/catalogue")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(f"{path}/catalogue")


def token_at(spark: SparkSession, path: str, doc_id: int, at: int) -> int:
    """Token `at` of document doc_id, from a few bytes of the one file that has it; of rows that share the id, the first.

    KeyError without such a document, IndexError where it has no such token.
    """
    row = catalogue(spark, path).filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "segment").select("file").first()
    if row:
        store, root = file_system(f"{path}/files")
        with store.open_input_file(f"{root}/{row['file']}") as file:
            segment = SegmentFile(file)
            if found := segment.place(doc_id):
                if not 0 <= at < found[1] - found[0]:
                    raise IndexError(at)
                return segment.token(found[0] + at)
    raise KeyError(doc_id)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, start): the number of ids in all segments before each.

    The driver gathers one number for each file part, not for each segment or document.
    """
    sizes = catalogue(spark, path).select("part", "segment", "n_ids")
    totals = sorted((r["part"], r["n"]) for r in sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in totals)])[:-1].tolist()
    first = spark.createDataFrame([(p, s) for (p, _), s in zip(totals, starts, strict=True)], "part int, part_start long")
    return sizes.join(first, "part").selectExpr(
        "part", "segment", "part_start + coalesce(sum(n_ids) OVER (PARTITION BY part ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start"
    )


def read_token_ids(spark: SparkSession, path: str, of: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """Each document of `path`: doc_id, start, n_tokens and value, which is of(its ids as uint32), of SQL type `kind`."""
    schema = f"doc_id long, start long, n_tokens long, value {kind}"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(f"{path}/files")
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as file:
                    doc_ids, places, ids = SegmentFile(file).whole()
                if len(ids) != row["n_ids"]:
                    raise ValueError(f"{row['file']} has {len(ids)} ids in place of {row['n_ids']}")
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, mask=doc_ids == NO_ID), "start": places[:-1] + row["start"], "n_tokens": np.diff(places),
                    "value": pa.array([of(ids[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]),
                })

    files = catalogue(spark, path).join(segment_starts(spark, path), ["part", "segment"]).select("file", "n_ids", "start")
    # a few rows of the catalogue a task, each of which is a file
    return files.repartition(partitions(spark)).mapInArrow(decode, schema)


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def op7_token_output(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    path = Scratch(spark, "token_output").path("segments")
    write_token_segments(documents(spark, sf_dir), path, tokenizer_path or default_tokenizer())
    return read_token_ids(spark, path, crc32_of_ids, "long").withColumnRenamed("value", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
