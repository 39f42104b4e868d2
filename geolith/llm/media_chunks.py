"""Media columns stored as content-defined chunks.

A medium is a WAVE file of unsigned 8-bit samples in one channel: 44 bytes of header, then the payload. It is cut where a rolling gear hash of its last 32 bytes begins with BITS zero bits, at least LEAST and
at most MOST bytes apart, so that equal stretches of different media are cut alike. Chunks are kept once, in
a table bucketed by digest: a batch's chunks meet it in an anti-join and only new digests are written. A
medium is the ordered list of its chunks; documents point to media. Reading joins lists and chunks,
puts every distinct medium together again, verifies the file against its own digest and takes the samples out of it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.kernels import blocks
from geolith.llm.shared import BucketedTable, Scratch, documents, ready

#: Cuts are 2 ** BITS bytes apart on average, beyond LEAST.
BITS, LEAST, MOST = 13, 2048, 65536
#: Payloads are filled with bytes 0 up to a multiple of UNIT.
UNIT = 64
RATE = 8000
#: So many chunks, of as many documents at most, teach the compressor's dictionary.
DICTIONARY_CHUNKS, DICTIONARY_BYTES, LEVEL = 1500, 112_640, 7

_GEAR = np.random.Generator(np.random.PCG64(20241105)).integers(0, 1 << 32, 256, dtype=np.uint32)


def payload(text: bytes) -> bytes:
    """The text with bytes 0 after it, up to a positive multiple of UNIT."""
    return text.ljust(max(-(-len(text) // UNIT), 1) * UNIT, b"\0")


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 32 bytes up to each place, by doubling the stretch."""
    h, step = _GEAR[data], 1
    while step < 32:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n]
    # the hash's high bits depend on all of its 32 bytes
    candidates = np.flatnonzero(gear(np.frombuffer(data, np.uint8)) >> np.uint32(32 - BITS) == 0) + 1
    ends, last = [], 0
    while n - last > LEAST:
        k = int(np.searchsorted(candidates, last + LEAST))
        end = min(int(candidates[k]) if k < len(candidates) else n, last + MOST, n)
        ends.append(end)
        last = end
    if last < n:
        ends.append(n)
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def wave_header(n: int) -> bytes:
    """Of a file with n bytes of unsigned 8-bit samples; sizes beyond 32 bits are written as 2**32 - 1."""
    size = lambda x: min(x, (1 << 32) - 1)
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", size(36 + n), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", size(n))


def wave(samples: bytes) -> bytes:
    """The file that is stored."""
    return wave_header(len(samples)) + samples


def wave_samples(medium: bytes) -> bytes:
    """The samples of such a file, whose header must be the one that it was written with."""
    samples = medium[44:]
    if medium[:44] != wave_header(len(samples)):
        raise ValueError("not a file of 8-bit samples in one channel")
    return samples


def _cut_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in blocks(batch["text"]):
            yield pa.RecordBatch.from_arrays([pa.array([c for t in texts for c in chunks(t) if len(c) > 64], pa.binary())], ["data"])


class ChunkStore(BucketedTable):
    """The chunk table under `path`: digest, and data compressed by zstandard with the dictionary beside it.

    The dictionary is learned once, from DICTIONARY_CHUNKS chunks of as many documents, the first by a hash, and stays with the store.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        super().__init__(spark, path, "digest BINARY, data BINARY", "digest", buckets, "uncompressed")
        self.dictionary: bytes | None = None

    def learn(self, docs: DataFrame) -> bytes:
        ready(self.spark)
        if self.dictionary is None:
            at = f"{self.path}/dictionary"
            try:
                self.dictionary = bytes(self.spark.read.parquet(at).first()["dictionary"])
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(DICTIONARY_CHUNKS)
                some = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text")  # at most DICTIONARY_CHUNKS ids
                samples = [bytes(r["data"]) for r in some.mapInArrow(_cut_plain, "data binary").orderBy(F.xxhash64("data")).limit(DICTIONARY_CHUNKS).collect()]
                trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if sum(map(len, samples)) > 10 * DICTIONARY_BYTES else b""
                self.spark.createDataFrame([(bytearray(trained),)], "dictionary binary").write.parquet(at)
                self.dictionary = trained
        return self.dictionary

    def add(self, docs: DataFrame) -> None:
        """Writes the chunks of the texts that the store does not hold yet."""
        trained = self.learn(docs)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None, write_content_size=True, write_checksum=False, write_dict_id=False).compress
            seen: set[bytes] = set()  # of this task
            for batch in batches:
                for _, texts in blocks(batch["text"]):
                    own = {digest(c): c for t in texts for c in chunks(wave(payload(t)))}
                    new = [(d, compress(c)) for d, c in own.items() if d not in seen]
                    seen.update(own)
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in new], pa.binary()), pa.array([c for _, c in new], pa.binary())], ["digest", "data"])

        # dealt out once, as the table's buckets are: the anti-join, the removal of copies and the write need no more
        dealt = docs.select("text").mapInArrow(cut, "digest binary, data binary").repartition(self.buckets, "digest")
        new = dealt.join(self.rows().select("digest").hint("merge"), "digest", "left_anti").dropDuplicates(["digest"])
        self.append(new)


def media_lists(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, medium, digests): the medium's own digest and those of its chunks, in order."""
    ready(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            for first, texts in blocks(batch["text"]):
                full = [wave(payload(t)) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array([digest(p) for p in full], pa.binary()), pa.array([[digest(c) for c in chunks(p)] for p in full], pa.list_(pa.binary()))],
                    ["doc_id", "n_bytes", "medium", "digests"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, "doc_id long, n_bytes long, medium binary, digests array<binary>")


def feature(samples: bytes) -> str:
    """Mean, root mean square about it, share of sign changes and length in seconds of 8-bit samples."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    n, total, squares = len(x), int(x.sum()), int((x * x).sum())
    spread = max(squares / n - (total / n) ** 2, 0.0) ** 0.5
    changes = int(np.count_nonzero(np.diff(x * n > total)))
    return f"mean={total / n:.4f};rms={spread:.4f};crossings={changes};seconds={n / RATE:.3f}"


FEATURES = "medium binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_NAMES = [part.split()[0] for part in FEATURES.split(", ")]


def _features(medium: bytes, stored: bytes) -> tuple:
    """All that is said of a medium, from the bytes read back."""
    if digest(stored) != medium:
        raise ValueError(f"medium {medium.hex()} does not read back as it was written")
    samples = wave_samples(stored)
    return medium, len(samples), digest(samples).hex(), zlib.crc32(samples[-UNIT:]), len(stored), medium.hex(), feature(samples)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)


def read_media(media: DataFrame, store: ChunkStore) -> DataFrame:
    """FEATURES of every (medium, digests), from the stored chunks. A medium that fails its digest is an error."""
    trained = store.learn(media)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None).decompress
        for batch in batches:
            yield batch, [decompress(x.as_buffer()) for x in batch["data"]]

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data in expand(batches):
            yield _table([_features(m, c) for m, c in zip(batch["medium"].to_pylist(), data, strict=True)])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by medium and place."""
        medium, held = None, []
        for batch, data in expand(batches):
            rows = []
            for m, c in zip(batch["medium"].to_pylist(), data, strict=True):
                if m != medium and held:
                    rows.append(_features(medium, b"".join(held)))
                    held = []
                medium = m
                held.append(c)
            yield _table(rows)
        if held:
            yield _table([_features(medium, b"".join(held))])

    parts = media.select("medium", F.size("digests").alias("n"), F.posexplode("digests").alias("place", "digest"))
    found = parts.join(store.rows().hint("merge"), "digest")
    ones = found.filter("n = 1").select("medium", "data").mapInArrow(single, FEATURES)
    many = found.filter("n > 1").select("medium", "place", "data").repartition("medium").sortWithinPartitions("medium", "place").mapInArrow(in_order, FEATURES)
    return ones.union(many)


def media_columns(docs: DataFrame, store: ChunkStore) -> DataFrame:
    """Stores every row's text as a medium and returns doc_id, n_bytes and what its stored form reads as.

    Null text counts as empty, which makes a payload of UNIT bytes 0. Rows with equal texts share a medium; repeated
    and null doc_ids keep their rows. A very long text is one medium of many chunks, which one task holds at a time. Empty
    input gives no rows. Other columns are ignored.
    """
    work = Scratch(store.spark, "media_columns")
    store.add(docs)
    lists = work.table(media_lists(docs), "lists")
    media = lists.groupBy("medium").agg(F.first("digests").alias("digests"))
    features = work.table(read_media(media, store), "features")
    return lists.select("doc_id", "n_bytes", "medium").join(features, "medium").drop("medium")


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir), ChunkStore(spark, Scratch(spark, "media_store").path("store")))
