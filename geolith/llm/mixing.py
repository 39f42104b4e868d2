"""Mixing to target weights by soft membership.

A classifier learned from a labelled table gives each document its posterior over domains. Each document gets
a rate, how often it is expected to be used, so that the expected tokens of every domain match its target:
least squares in the residuals of the domains, by projected gradient from rate 1 for all. A gradient step
needs one number for each domain, so a round is one sum over the documents, and a document's rate follows
from its posterior and the steps so far: no state is kept for each document between rounds.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.kernels import SPACE, blocks, joined, runs
from geolith.llm.shared import Scratch, documents, fresh_names, ready
from geolith.llm.subwords import Settings, class_scores, train

SETTINGS = Settings(bits=16, dim=8, ngrams=(4,), sample_per_class=600, epochs=5)
#: A target is met within CLOSE of itself. Targets are out of reach once a bound proves it, or once the projected gradient is below STILL of the gradient.
CLOSE, STILL = 1e-5, 1e-6
#: Steps that are tried together, in one pass: lengths in the metric of all rows, and shares of that metric beside the rows within their bounds.
LENGTHS, SHARES = (4.0, 1.0), (0.3, 0.1, 0.03, 0.01, 1e-3, 1e-4, 1e-6, 0.0)
#: Without repeats, a total stays this share below the bound that rules out more, and goes down by as much after so many passes that do not meet it.
MARGIN, PATIENCE = 0.01, 8
#: Target weights of the domains, here the languages of the documents.
TARGETS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def rates(posterior: np.ndarray, steps: list[np.ndarray], most: float) -> np.ndarray:
    """The rates that the steps lead to, each projected to 0 to most."""
    out = np.minimum(np.ones(len(posterior)), most)
    for step in steps:
        out = np.clip(out - posterior @ step, 0.0, most)
    return out


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], settings: Settings = SETTINGS) -> DataFrame:
    """(doc_id, n_tokens, posterior): words of the whole text and its posterior over the domains, in their order.

    labelled has doc_id and domain; rows of other domains are left out.
    """
    spark = docs.sparkSession
    index = F.create_map(*[F.lit(x) for k, d in enumerate(domains) for x in (d, k)])
    known = labelled.filter(F.col("domain").isin(domains)).select(F.col("doc_id").cast("long").alias("doc_id"), index[F.col("domain")].alias("label"))
    table = spark.sparkContext.broadcast(train(docs, known, len(domains), settings))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            for first, texts in blocks(batch["text"]):
                data, begin, end = joined(texts)
                starts, _ = runs(~SPACE[data])
                words = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
                shares = class_scores(texts, table.value, settings)
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)), pa.array(words, pa.int64()), pa.array(list(shares), pa.list_(pa.float64()))], ["doc_id", "n_tokens", "posterior"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, n_tokens long, posterior array<double>")


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return batch["posterior"].flatten().to_numpy().reshape(-1, n)


@dataclass(frozen=True)
class Fit:
    """Steps that the rates follow from, and of each domain the expected tokens at those rates and the target."""

    steps: list[np.ndarray]
    have: np.ndarray
    want: np.ndarray

    @property
    def off(self) -> np.ndarray:
        """How far each domain is from its target, as a share of it; of all targets where its own is 0."""
        return np.abs(self.have - self.want) / np.maximum(np.where(self.want > 0, self.want, self.want.sum()), 1e-300)

    @property
    def met(self) -> bool:
        return bool((self.off <= CLOSE).all())


@dataclass(frozen=True)
class Measured:
    """Sums over all rows at some rates, for the direction that is asked about."""

    have: np.ndarray  # expected tokens of each domain
    free: np.ndarray  # tokens x p p' over the rows whose rates are within the bounds
    reach: float  # the most that any rates give along the direction; infinite where it is unbounded
    gradient: float  # tokens x (p . direction)^2
    projected: float  # of the rows whose rates the bounds let follow it


def measured(p: np.ndarray, tokens: np.ndarray, steps: list[np.ndarray], tried: list[np.ndarray], along: list[np.ndarray], most: float) -> np.ndarray:
    """What some rows add to the sums, a row of numbers for each step that is tried: after `steps` and that step, and along that direction."""
    n = p.shape[1]
    before, out = rates(p, steps, most), np.zeros((len(tried), n + n * n + 3))
    for k, (step, direction) in enumerate(zip(tried, along, strict=True)):
        r = np.clip(before - p @ step, 0.0, most)
        inside, pull = (r > 0) & (r < most), p @ direction
        held = p[inside]
        follows = inside | ((r <= 0) & (pull > 0)) | ((r >= most) & (pull < 0))
        out[k, :n] = (tokens * r) @ p
        out[k, n:-3] = ((held * tokens[inside, None]).T @ held).ravel()
        out[k, -3] = (tokens * np.maximum(pull, 0)).sum()
        out[k, -2:] = (tokens * pull * pull).sum(), (tokens * pull * pull)[follows].sum()
    return out


def _read(numbers: np.ndarray, n: int, most: float) -> list[Measured]:
    reach = lambda x: x * most if np.isfinite(most) else (np.inf if x > 0 else 0.0)
    return [Measured(row[:n], row[n:-3].reshape(n, n), reach(row[-3]), row[-2], row[-1]) for row in numbers]


Measure = Callable[[list[np.ndarray], list[np.ndarray], list[np.ndarray]], list[Measured]]


def over(members: DataFrame, n: int, most: float) -> Measure:
    """Measures all rows of (n_tokens, posterior) in one pass of tasks, whose few numbers the driver gets summed up."""

    def measure(steps: list[np.ndarray], tried: list[np.ndarray], along: list[np.ndarray]) -> list[Measured]:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((len(tried), n + n * n + 3))
            for batch in batches:
                held += measured(_matrix(batch, n), batch["n_tokens"].to_numpy().astype(np.float64), steps, tried, along, most)
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(held.size), pa.int32()), "amount": held.ravel()})

        sums = members.mapInArrow(part, "place int, amount double").groupBy("place").agg(F.sum("amount").alias("amount")).collect()
        out = np.zeros((len(tried), n + n * n + 3))
        for row in sums:
            out.flat[row["place"]] = row["amount"]
        return _read(out, n, most)

    return measure


def _inverse(gram: np.ndarray) -> np.ndarray:
    """The pseudo-inverse, from the gram of domains that are brought to one size first: small ones count as much as large ones."""
    size = np.sqrt(np.diag(gram))
    scale = np.where(size > 0, 1 / np.where(size > 0, size, 1), 0)
    return scale[:, None] * np.linalg.pinv(scale[:, None] * gram * scale, rcond=1e-12) * scale


def fit(measure: Measure, weights: np.ndarray, total: float | None = None, most: float = float("inf")) -> Fit:
    """Steps whose rates bring the domains' expected tokens to weights x total.

    The least squares are those in the metric of the domains' shared tokens, in which projected steps of length 1 always
    descend. Each pass over the documents tries steps of several lengths, and some in the metric of the rows that are
    within their bounds, and keeps the one that descends furthest. Ends when every target is met within CLOSE of itself, or is proven out of reach:
    along y = metric x (want - have), no rates give more than the sums `reach`, so that y . want above it rules the targets out. The rates then bring
    them as near as they can come: until what the bound leaves open, or the projected gradient, is next to nothing.

    total is all tokens there are by default; without repeats (most = 1) it is near the largest that the weights allow: it begins at what the scarcest domain has, and each such bound
    y . (weights x total) <= reach lowers it to what the bound leaves, in either case less MARGIN. As a proof may take long where a total is barely out of reach, PATIENCE passes that do not meet it lower it by MARGIN, too. Where next to nothing is left, as for a domain that no document is in, total is all tokens again,
    and out of reach.
    """
    n, steps, first = len(weights), [], min(1.0, most)
    zero = np.zeros(n)
    now, half = measure(steps, [zero, np.full(n, first / 2)], [zero, zero])
    if not now.have.sum():
        return Fit(steps, now.have, now.have)
    lowered = total is None and most <= 1
    if total is None:
        total = now.have.sum()
        if lowered:
            total = float(min(total, np.min(now.have[weights > 0] / weights[weights > 0]))) * (1 - MARGIN)
    metric, want, least = _inverse(half.free), weights * total, CLOSE * now.have.sum()
    if lowered and total < least:
        return fit(measure, weights, now.have.sum(), most)
    loss = lambda x: float((x - want) @ metric @ (x - want))
    tries = 0
    while not Fit(steps, now.have, want).met:
        tries += 1
        off = now.have - want
        pull = -metric @ off
        tried = [zero] + [metric @ off * k for k in LENGTHS] + [_inverse(now.free + half.free * k) @ off for k in SHARES]
        here, *found = measure(steps, tried, [pull] * len(tried))
        if lowered and (here.reach < pull @ want or tries > PATIENCE):
            total, tries = min(total, here.reach / (pull @ weights) if pull @ weights > 0 else total) * (1 - MARGIN), 0
            if total < least:
                return fit(measure, weights, measure([], [zero], [zero])[0].have.sum(), most)
            want = weights * total
            now = here
            continue
        if not lowered and (here.reach - pull @ here.have < STILL * loss(here.have) or here.projected <= STILL**2 * here.gradient):
            break
        best = min(range(len(found)), key=lambda k: loss(found[k].have))
        if loss(found[best].have) >= loss(here.have):
            break  # nothing descends any further in double precision
        steps.append(tried[best + 1])
        now = found[best]
    return Fit(steps, now.have, want)


def mixed_rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], total: float | None = None, most: float = float("inf"), settings: Settings = SETTINGS) -> DataFrame:
    """Each row's doc_id, n_tokens, posterior, rate and copies.

    copies is the whole part of the rate, or one more with the probability of the rest, by a hash of doc_id and n_tokens: its
    expectation is the rate, and repeated rows fall alike. Targets out of reach are met as nearly as the least squares can, with
    a warning. With most = 1 no document is repeated, so that the domain that is scarcest for its target bounds the total;
    give a smaller or larger `total` where that is not wanted. Null text counts as empty and gets the posterior of no
    evidence, equal for all domains. Targets need not sum to 1. Without labelled rows all posteriors are equal.
    Repeated and null doc_ids keep their rows. A very long text is read whole; that takes about 60 bytes of a task's memory
    for each of its own. Other columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    domains = sorted(targets)
    weights = np.array([targets[d] for d in domains], np.float64)
    if not domains or (weights < 0).any() or not weights.sum():
        raise ValueError("targets must be nonnegative and have a positive sum")
    weights /= weights.sum()
    members = Scratch(spark, "mixing").table(posteriors(docs, labelled, domains, settings), "members")
    fitted = fit(over(members.select("n_tokens", "posterior"), len(domains), most), weights, total, most)
    if not fitted.met:
        warnings.warn("targets out of reach, off by " + ", ".join(f"{d}: {x:.2%}" for d, x in zip(domains, fitted.off, strict=True)), stacklevel=2)
    steps = fitted.steps

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("rate", pa.array(rates(_matrix(batch, len(domains)), steps, most)))

    rated = members.mapInArrow(rate, "doc_id long, n_tokens long, posterior array<double>, rate double")
    chance = F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], most: float = 1.0) -> DataFrame:
    """The rows of docs, each as often as its copies say, with all their columns; with most = 1 none is repeated.

    Rows that share a doc_id share the largest of their copies; rows with a null doc_id go.
    """
    key, times, nth = fresh_names(3)
    used = mixed_rates(docs, labelled, targets, most=most).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times)).filter(F.col(times) > 0)
    rows = docs.withColumn(key, F.col("doc_id").cast("long")).join(used, key)
    if most > 1:
        rows = rows.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times))))
    return rows.select(*docs.columns)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rated = mixed_rates(docs, docs.select("doc_id", F.col("lang").alias("domain")), TARGETS)
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(sorted(TARGETS))]
    return rated.select("doc_id", "n_tokens", *shares, "rate", "copies")
