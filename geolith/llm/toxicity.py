"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is the logistic of a sum of weights of its words and word beginnings; a document's is
the noisy-or of its sentences, 1 - prod(1 - p). The weights are learned from document labels alone, by
gradients through the noisy-or, and then tell which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.kernels import ALNUM, LOWER, Hashes, blocks, joined, runs, segment_sums
from geolith.llm.shared import documents, ready
from geolith.llm.subwords import sampled, teaching


@dataclass(frozen=True)
class Settings:
    bits: int = 18  # log2 of the number of buckets
    prefixes: tuple[int, ...] = (3, 4, 5, 6, 7)  # bytes of a word's beginning
    sample_per_class: int = 2000
    sample_bytes: int = 1 << 24  # of the texts that teach one label; none has more than a 64th
    steps: int = 60
    rate: float = 0.1
    shrink: float = 1.2  # L1 penalty, as the loss of so many documents
    spread: float = 0.3  # L2 penalty likewise: words that occur together share the weight
    trust: float = 2.5  # standard errors taken off the log odds that weights start from
    start: float = -7.0  # logit of a sentence without weights


#: Bytes that end a sentence: newline, carriage return, ! . ?
_STOPS = np.zeros(256, bool)
_STOPS[[10, 13, 33, 46, 63]] = True


class Sentences:
    """The sentences of some texts and the buckets of their words; a stretch without a word is no sentence."""

    def __init__(self, texts: list[bytes], settings: Settings) -> None:
        raw, first, last = joined(texts)
        data = LOWER[raw]
        hashes, shift = Hashes(data), np.uint64(64 - settings.bits)
        starts, ends = runs(ALNUM[data])
        stops = np.cumsum(_STOPS[raw])
        number = stops[starts]
        opens = np.flatnonzero(np.diff(number, prepend=-1))
        self.starts, self.ends = starts[opens], ends[np.append(opens[1:], len(starts))[: len(opens)] - 1] if len(opens) else ends[:0]
        self.lo, self.hi = np.searchsorted(self.starts, first), np.searchsorted(self.starts, last)
        self.first = first
        sizes = ends - starts
        kinds = [hashes.of(starts, ends)]
        at = [np.arange(len(starts))]
        for n in settings.prefixes:
            long = np.flatnonzero(sizes > n)
            kinds.append(hashes.of(starts[long], starts[long] + n) + np.uint64(n))
            at.append(long)
        # each word's features stand together, so that a sentence's are one range
        order = np.argsort(np.concatenate(at), kind="stable")
        place = np.concatenate(at)[order]
        self.buckets = (np.concatenate(kinds)[order] * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        self.flo = np.searchsorted(place, opens)
        self.fhi = np.append(self.flo[1:], len(place))[: len(opens)]

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """A bucket counts once in a sentence, however often it occurs there."""
        hit = np.flatnonzero(weights[self.buckets])
        key = np.unique((np.searchsorted(self.flo, hit, side="right") - 1) * len(weights) + self.buckets[hit])
        sentence, bucket = np.divmod(key, len(weights))
        return bias + np.bincount(sentence, weights[bucket], minlength=len(self.flo))


def _log_clean(z: np.ndarray) -> np.ndarray:
    """log(1 - p) of sentences with logit z."""
    return -np.logaddexp(0, z)


def learn(rows: list[tuple[int, list[np.ndarray]]], counts: dict[int, int], settings: Settings) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the bias, from (label, buckets of each sentence).

    counts has how many documents carry each label: a sampled row stands for its share of them.
    """
    size = 1 << settings.bits
    if len({y for y, _ in rows}) < 2:
        return np.zeros(size), settings.start
    by = np.zeros((2, size))
    for y, sentences in rows:
        by[y, np.unique(np.concatenate(sentences or [np.zeros(0, np.int64)]))] += 1
    used = np.flatnonzero(by.sum(0))
    index = np.full(size, -1, np.int64)
    index[used] = np.arange(len(used))
    label, doc, sentence, feature = np.array([y for y, _ in rows]), [], [], []
    for d, (_, sentences) in enumerate(rows):
        for s in sentences:
            own = index[s]
            doc.append(d)
            feature.append(own[own >= 0])
    sentence = np.repeat(np.arange(len(doc)), list(map(len, feature)))
    doc, feature = np.array(doc, np.int64), np.concatenate([*feature, np.zeros(0, np.int64)])
    per = {y: counts[y] / max(int((label == y).sum()), 1) for y in (0, 1)}
    weight = np.where(label == 1, per[1], per[0])
    weight = weight / weight.mean()
    # words that only toxic documents have start high, or those beside them would explain their documents first
    clean_n, toxic_n = by[:, used] + 0.5
    odds = np.log(toxic_n / (1 + (label == 1).sum())) - np.log(clean_n / (1 + (label == 0).sum()))
    w, b = np.maximum(odds - settings.trust * np.sqrt(1 / toxic_n + 1 / clean_n), 0.0) / 3, settings.start
    free = w > 0  # well-founded weights are not penalised: once others explain their documents, only the penalty would move them
    shrink, spread = np.where(free, 0.0, settings.shrink / len(rows)), np.where(free, 0.0, settings.spread / len(rows))
    first, second, first_b, second_b = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, settings.steps + 1):
        z = b + np.bincount(sentence, w[feature], minlength=len(doc))
        clean = np.bincount(doc, _log_clean(z), minlength=len(label))
        toxic = -np.expm1(clean)
        # d loss / d z of a sentence: p for clean documents, -p (1 - P) / P for toxic ones
        pull = np.where(label == 1, -np.exp(clean) / np.maximum(toxic, 1e-9), 1.0) * weight / len(label)
        g = pull[doc] / (1 + np.exp(-z))
        gw, gb = np.bincount(feature, g[sentence], minlength=len(used)) + spread * w, g.sum()
        # at 0 a weight moves only if its gradient outweighs the penalty
        gw = np.where(w != 0, gw + shrink * np.sign(w), np.sign(gw) * np.maximum(np.abs(gw) - shrink, 0))
        first, second = 0.9 * first + 0.1 * gw, 0.99 * second + 0.01 * gw * gw
        first_b, second_b = 0.9 * first_b + 0.1 * gb, 0.99 * second_b + 0.01 * gb * gb
        rate = settings.rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        moved = w - rate * first / (np.sqrt(second) + 1e-9)
        w = np.where((w != 0) & (np.sign(moved) != np.sign(w)), 0.0, moved)
        b -= rate * first_b / (np.sqrt(second_b) + 1e-9)
    weights = np.zeros(size)
    weights[used] = w
    return weights, float(b)


def toxicity_model(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Learns labels.toxic from (doc_id, toxic) and the whole texts of at most sample_per_class documents a label."""
    ready(docs.sparkSession)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch["doc_id"].to_pylist(), batch["label"].to_pylist()
            for first, texts in blocks(batch["text"]):
                s = Sentences(texts, settings)
                each = [[np.unique(s.buckets[s.flo[k] : s.fhi[k]]).astype(np.int32).tobytes() for k in range(lo, hi)] for lo, hi in zip(s.lo, s.hi, strict=True)]
                n = len(texts)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids[first : first + n], pa.int64()), "label": pa.array(own[first : first + n], pa.int32()), "sentences": pa.array(each, pa.list_(pa.binary()))})

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    counts = {0: 1, 1: 1} | {r["label"]: r["n"] for r in known.filter("label IN (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = teaching(docs, sampled(known, 2, settings.sample_per_class), settings.sample_bytes).mapInArrow(featurise, "doc_id long, label int, sentences array<binary>")
    table = rows.toArrow().sort_by("doc_id")
    found = [(y, [np.frombuffer(x, np.int32) for x in s]) for y, s in zip(table["label"].to_pylist(), table["sentences"].to_pylist(), strict=True)]
    return learn(found, counts, settings)


OUTPUT = "doc_id long, score double, n_sentences long, n_offending long, worst_start long, worst_end long, offending array<struct<start:long,end:long,score:double>>"
_OFFENDING = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def with_toxicity(docs: DataFrame, model: tuple[np.ndarray, float], settings: Settings = Settings(), offends: float = 0.5) -> DataFrame:
    """Each row's noisy-or score and its offending sentences, of a score of at least `offends`.

    start and end are code points of the text, from the sentence's first word to its last; worst_* is the
    sentence with the highest score, the first of equals. Null text counts as empty; a text without words
    scores 0 and has null worst_*. Without labels of both kinds all weights are 0. Repeated and null doc_ids
    keep their rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            ids = batch["doc_id"]
            for first, texts in blocks(batch["text"]):
                s = Sentences(texts, settings)
                z = s.logits(weights, bias)
                doc = -np.expm1(segment_sums(_log_clean(z), s.lo, s.hi))
                p = 1 / (1 + np.exp(-z))
                rows = [_located(texts[k], s, p, k, offends) for k in range(len(texts))]
                counts, worst_a, worst_b, offending = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array(doc), pa.array(s.hi - s.lo), pa.array(counts, pa.int64()), pa.array(worst_a, pa.int64()), pa.array(worst_b, pa.int64()), pa.array(offending, _OFFENDING)],
                    ["doc_id", "score", "n_sentences", "n_offending", "worst_start", "worst_end", "offending"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, OUTPUT)


def _located(text: bytes, s: Sentences, p: np.ndarray, k: int, offends: float) -> tuple:
    lo, hi, base = int(s.lo[k]), int(s.hi[k]), int(s.first[k])
    if lo == hi:
        return 0, None, None, []
    point = (lambda at: at) if text.isascii() else (lambda at: len(text[:at].decode()))
    span = lambda j: (point(int(s.starts[j]) - base), point(int(s.ends[j]) - base))
    bad = lo + np.flatnonzero(p[lo:hi] >= offends)
    spans = [{"start": a, "end": b, "score": float(p[j])} for j in bad for a, b in [span(j)]]
    return len(bad), *span(lo + int(np.argmax(p[lo:hi]))), spans


def held_out(doc_id: F.Column) -> F.Column:
    """Whether crc32 of doc_id as text leaves no remainder by 5; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    scored = with_toxicity(docs, toxicity_model(docs, labels.filter(~held_out(F.col("doc_id")))))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "n_offending", "worst_start", "worst_end")
