"""Supervised subword embeddings: a document is the mean of the vectors of its hashed words, word pairs
and character n-grams; a softmax over that mean gives its classes. Vectors and softmax are learned
together by stochastic gradient descent in numpy.

The rows that teach it are bounded by `sample_per_class` and their texts by `sample_bytes`, so that their features, which travel packed, fit the driver; all other work is one pass over the documents. As the output is linear in the vectors, tasks get one table
of class scores for each bucket, of a size that `bits` fixes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.llm.kernels import SPACE, Hashes, blocks, joined, mixed, runs, segment_sums
from geolith.llm.shared import ready


@dataclass(frozen=True)
class Settings:
    bits: int = 17  # log2 of the number of buckets
    dim: int = 12  # of the vectors
    ngrams: tuple[int, ...] = (3, 5)  # bytes of a character n-gram
    sample_per_class: int = 1200
    sample_bytes: int = 1 << 24  # of the texts that teach one class; none has more than a 64th
    epochs: int = 8
    rate: float = 0.6
    seed: int = 7


class Features:
    """Buckets of every feature of some texts, as arrays with the range of each text."""

    def __init__(self, texts: list[bytes], settings: Settings) -> None:
        data, first, last = joined(texts)
        hashes, shift = Hashes(data), np.uint64(64 - settings.bits)
        starts, ends = runs(~SPACE[data])
        words = hashes.of(starts, ends)
        lo, hi = np.searchsorted(starts, first), np.searchsorted(starts, last)
        # a pair is hashed by the difference of its words, so that all immediate repetitions share one bucket
        pairs = mixed(words[1:] * np.uint64(3) - words[:-1] * np.uint64(3) + np.uint64(0x5851F42D4C957F2D))
        self.groups = [((words >> shift), lo, hi), ((pairs >> shift), lo, np.maximum(lo, hi - 1))]
        for n in settings.ngrams:
            self.groups.append((mixed(hashes.ngrams(n) + np.uint64(n)) >> shift, first, np.maximum(first, last - n + 1)))
        self.n = sum(e - s for _, s, e in self.groups)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """The mean of table's rows over each text's features; zeros where it has none."""
        total = sum(segment_sums(table[b.astype(np.int64)], s, e) for b, s, e in self.groups)
        return total / np.maximum(self.n, 1).reshape(-1, *[1] * (table.ndim - 1))

    def counts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Text k's distinct buckets and how often each occurs."""
        buckets, n = np.unique(np.concatenate([b[s[k] : e[k]] for b, s, e in self.groups]), return_counts=True)
        return buckets.astype(np.int64), n


def packed(buckets: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending buckets and their counts in a few bytes each, for the way to the driver."""
    raw = np.concatenate([np.diff(buckets, prepend=0), n]).astype("<u4")
    return zstandard.compress(np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def unpacked(data: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    raw = np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(raw[: len(raw) // 2], dtype=np.int64), raw[len(raw) // 2 :]


def learn(labels: np.ndarray, features: Callable[[int], tuple[np.ndarray, np.ndarray]], n_classes: int, settings: Settings) -> np.ndarray:
    """The table of class scores (buckets x classes) from each row's class, and its buckets and their shares.

    Classes weigh alike whatever their number of rows; without rows all scores are 0.
    """
    rng = np.random.Generator(np.random.PCG64(settings.seed))
    vectors = rng.uniform(-1, 1, (1 << settings.bits, settings.dim)) / settings.dim
    outputs = np.zeros((settings.dim, n_classes))
    if not len(labels):
        return vectors @ outputs
    weight = len(labels) / n_classes / np.maximum(np.bincount(labels, minlength=n_classes), 1)
    steps = settings.epochs * len(labels)
    for step, k in enumerate(np.concatenate([rng.permutation(len(labels)) for _ in range(settings.epochs)])):
        label, (buckets, shares) = labels[k], features(int(k))
        if not len(buckets):
            continue
        mean = shares @ vectors[buckets]
        p = mean @ outputs
        p = np.exp(p - p.max())
        p /= p.sum()
        p[label] -= 1
        p *= settings.rate * (1 - step / steps) * weight[label]
        back = outputs @ p
        outputs -= np.outer(mean, p)
        # each vector moves as if it were the whole mean: shares alone would be too small to learn from
        vectors[buckets] -= np.outer(shares / max(float(shares.max()), 1e-9), back) * 0.5
    return vectors @ outputs


def sampled(labelled: DataFrame, n_classes: int, per_class: int) -> DataFrame:
    """At most per_class rows (doc_id, label) of each label from 0, the first by a hash of doc_id.

    Rows with a null are left out; a doc_id with several labels counts with the largest.
    """
    one = labelled.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    some = [one.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in range(n_classes)]
    return reduce(DataFrame.union, some)


def teaching(docs: DataFrame, chosen: DataFrame, most_bytes: int) -> DataFrame:
    """(doc_id, label, text) of the chosen (doc_id, label): one row each, whose texts have most_bytes a label at most.

    Of rows that share a doc_id, the shortest text teaches, and of equally short ones the first by a hash. Texts of more than a 64th of
    the bytes teach nothing, nor do those with which a label's texts, in the order of a hash of doc_id, exceed them.
    """
    # chosen is bounded by the sample, so that it may be sent to all tasks
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    size = F.octet_length("text")
    rows = rows.filter(size <= most_bytes // 64).groupBy("doc_id", "label").agg(F.min(F.struct(size.alias("size"), F.xxhash64("text").alias("tie"), "text")).alias("r"))
    before = F.sum("r.size").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))  # of a sample's rows
    return rows.withColumn("before", before).filter(F.col("before") <= most_bytes).select("doc_id", "label", "r.text")


def train(docs: DataFrame, labelled: DataFrame, n_classes: int, settings: Settings) -> np.ndarray:
    """Learns from (doc_id, label 0 to n_classes - 1) and the whole texts of those documents."""
    ready(docs.sparkSession)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch["doc_id"].to_pylist(), batch["label"].to_pylist()
            for first, texts in blocks(batch["text"]):
                features = Features(texts, settings)
                each = [features.counts(k) for k in range(len(texts))]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[first : first + len(texts)], pa.int64()), "label": pa.array(labels[first : first + len(texts)], pa.int32()),
                    "n": pa.array(features.n, pa.int64()), "features": pa.array([packed(*e) for e in each], pa.binary()),
                })

    chosen = sampled(labelled.select("doc_id", F.col("label").cast("int").alias("label")), n_classes, settings.sample_per_class)
    rows = teaching(docs, chosen, settings.sample_bytes).mapInArrow(featurise, "doc_id long, label int, n long, features binary")
    table = rows.toArrow().combine_chunks()
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    n, held = table["n"].to_numpy(), table["features"]

    def features(k: int) -> tuple[np.ndarray, np.ndarray]:
        buckets, times = unpacked(held[int(order[k])].as_buffer())
        return buckets, (times / max(int(n[order[k]]), 1)).astype(np.float32)

    return learn(table["label"].to_numpy()[order], features, n_classes, settings)


def class_scores(texts: list[bytes], table: np.ndarray, settings: Settings) -> np.ndarray:
    """Softmax over the classes, a row for each text."""
    z = Features(texts, settings).sums(table)
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)
