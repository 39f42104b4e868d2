"""License scans by ordered signature rules with a keyword prefilter.

A text becomes lower-case words joined by single spaces. One automaton finds the keywords of all rules in it; texts
without any are done. Else each rule is tried on the stretches of words around its keywords. A detection falls if another of a
higher priority, or of the same and longer or earlier in the rules, contains its interval.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.kernels import ALNUM, blocks, runs
from geolith.llm.license_rules import Rule, most_words, rules
from geolith.llm.shared import documents, ready

#: Phrases that are always counted, and their labels.
BASE = {(b"mit", b"license"): "mit", (b"apache", b"license"): "apache", (b"general", b"public", b"license"): "gpl"}
#: Bytes that stand in no word become spaces; the rest is lower case already.
_WORDS = bytes(c if ALNUM[c] else 32 for c in range(256))


@functools.cache
def compiled() -> list[tuple[Rule, re.Pattern]]:
    return [(rule, re.compile(rf"(?<!\S)(?:{rule.pattern})(?!\S)")) for rule in rules()]


@functools.cache
def reach() -> int:
    """Words on either side of a keyword that are read: no match is longer."""
    return max(most_words(rule.pattern) for rule, _ in compiled())


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """Finds the keywords; the value of each is its length and the numbers of the rules that have it."""
    owners: dict[str, list[int]] = {}
    for k, (rule, _) in enumerate(compiled()):
        for word in rule.keywords:
            owners.setdefault(word, []).append(k)
    found = ahocorasick.Automaton()
    for word, numbers in owners.items():
        found.add_word(word, (len(word), numbers))
    found.make_automaton()
    return found


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of each place where a base phrase stands."""
    return [(k + 1 - len(phrase), label) for k, word in enumerate(words) if word == b"license" for phrase, label in BASE.items() if k + 1 >= len(phrase) and tuple(words[k + 1 - len(phrase) : k + 1]) == phrase]


def detect(words: list[bytes]) -> list[tuple[int, int, str, float, str]]:
    """(first word, end word, label, score, rule) of detections that stand, in order of place."""
    whole = b" ".join(words).decode()
    hits = [(end + 1 - size, numbers) for end, (size, numbers) in automaton().iter(whole)]
    if not hits:
        return []
    around = reach()
    begin = np.cumsum([0, *map(len, whole.split(" "))]) + np.arange(len(words) + 1)  # where each word begins, and where one more would
    at = np.searchsorted(begin, [a for a, _ in hits], side="right") - 1
    near = np.zeros(len(words) + 1, np.int64)
    np.add.at(near, np.maximum(at - around, 0), 1)
    np.add.at(near, np.minimum(at + around + 1, len(words)), -1)
    starts, ends = runs(np.cumsum(near[:-1]) > 0)
    tried: list[set[int]] = [set() for _ in starts]
    for stretch, (_, numbers) in zip(np.searchsorted(starts, at, side="right") - 1, hits, strict=True):
        tried[stretch].update(numbers)
    found: list[tuple[int, int, int, int, Rule]] = []
    for first, end, numbers in zip(starts, ends, tried, strict=True):
        a, b = int(begin[first]), int(begin[end]) - 1
        for k in numbers:
            rule, pattern = compiled()[k]
            for m in pattern.finditer(whole, a, b):
                x, y = np.searchsorted(begin, (m.start(), m.end()))
                found.append((-rule.priority, int(x - y), k, int(x), rule))
    kept: list[tuple[int, int, str, float, str]] = []
    reaches: dict[int, int] = {}  # first word -> the last end of what stands there
    for _, size, _, start, rule in sorted(found, key=lambda x: x[:4]):
        end = start - size
        if all(reaches.get(a, -1) < end for a in range(start - around, start + 1)):
            kept.append((start, end, rule.label, rule.score, rule.name))
            reaches[start] = end
    return sorted(kept)


OUTPUT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<first_word:long,end_word:long,label:string,score:double,rule:string>>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("detections", pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("score", pa.float64()), ("rule", pa.string())]))),
])


def scan(text: bytes) -> tuple:
    """The columns after doc_id of a lower-case text."""
    words = text.translate(_WORDS).split()
    base = base_places(words)
    detections = detect(words)
    names = {label for _, label in base}
    chance = {label: max(d[3] for d in detections if d[2] == label) for label in {d[2] for d in detections}}
    score = 1.0 - float(np.prod([1.0 - chance[label] for label in sorted(chance)]))
    places = [k for k, _ in base]
    rows = [dict(zip(("first_word", "end_word", "label", "score", "rule"), d, strict=True)) for d in detections]
    return len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(names)), ",".join(sorted(names | set(chance))), score, rows


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Words, base phrases, labels, score and detections of each row's whole text; see OUTPUT.

    Words are counted from 0, end_word is exclusive. score is 1 - prod(1 - s) over the labels' best detections.
    Null text counts as empty: no words, empty labels, score 0. Repeated and null doc_ids keep their rows.
    A very long text is read whole. Other columns are ignored.
    """
    ready(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, texts in blocks(batch["text"]):
                texts = [t.lower() for t in texts]  # of bytes: A-Z alone
                rows = [(ids[first + k], *scan(text)) for k, text in enumerate(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, OUTPUT)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir)).drop("detections")
