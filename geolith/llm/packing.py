"""Best-fit packing by exact-complement hashing.

Lengths up to the sequence length are all that packing depends on, so the documents are reduced to a
count of pieces for each length: at most `capacity` numbers at any size of input. Over these counts,
the driver indexes once which single lengths, pairs and triples have which sum, consumes combinations that fill gaps exactly
under the counts that are left, and gives what remains to the best-fitting gap. A combination serves the longest piece that has no
place yet, so that it takes no gap that a longer piece could have had. The result is a list of patterns
(lengths, times used), also bounded by `capacity`. Pieces are then numbered within their length from
counts that each task kept, and their number picks the place; neither texts nor ids are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.shared import Scratch, documents
from geolith.llm.tokens import encoder, end_mark

CAPACITY, END_ID = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first piece may be shorter."""
    head = n % capacity
    return [(0, head)] * (head > 0) + [(at, capacity) for at in range(head, n, capacity)]


class SumIndex:
    """Which single lengths, pairs and triples have which sum, under the counts that are left.

    Lengths that are used up never come back, so that each list is read once from its start: pairs of a sum by their larger
    length, triples by their largest and the pairs of what that leaves. The longest come first, unless `upward`.
    """

    def __init__(self, counts: np.ndarray, upward: bool = False) -> None:
        self.left = counts.astype(np.int64)
        lengths = np.flatnonzero(self.left)
        order = lengths if upward else lengths[::-1]
        capacity = len(counts) - 1
        self.pairs: list[list[int]] = [[] for _ in range(capacity + 1)]  # sum -> larger lengths
        for a in order.tolist():
            for b in lengths[lengths <= a].tolist():
                if a + b <= capacity:
                    self.pairs[a + b].append(a)
        self.triples: list[list[int]] = [[a for a in order.tolist() if 3 * a >= total and a < total and self.pairs[total - a]] for total in range(capacity + 1)]  # sum -> largest lengths
        self.pair_at, self.triple_at = [0] * (capacity + 1), [0] * (capacity + 1)
        self.held: list[int] = []  # lengths that a combination in the making has taken

    def single(self, total: int, most: int | None = None) -> tuple[int, ...] | None:
        return (total,) if 0 < total <= (most or total) and self._free(total) > 0 else None

    def beside(self, length: int, gap: int) -> tuple[int, ...] | None:
        """What fills the gap exactly beside a piece of this length: one, two or three pieces, none longer than it."""
        self.held.append(length)
        found = next((f for of in (self.single, self.pair, self.triple) if (f := of(gap - length, length))), None) if gap > length else None
        self.held.pop()
        return found

    def _free(self, length: int) -> int:
        return int(self.left[length]) - self.held.count(length)

    def pair(self, total: int, most: int | None = None) -> tuple[int, ...] | None:
        """Two lengths with this sum, none longer than `most`."""
        found = self.pairs[total]
        while self.pair_at[total] < len(found) and self._used_up(found[self.pair_at[total]], total):
            self.pair_at[total] += 1
        for a in found[self.pair_at[total] :]:
            if (most is None or a <= most) and self._free(a) > (2 * a == total) and self._free(total - a) > 0:
                return a, total - a
        return None

    def _used_up(self, a: int, total: int) -> bool:
        return self.left[a] <= (2 * a == total) or self.left[total - a] <= 0

    def triple(self, total: int, most: int | None = None) -> tuple[int, ...] | None:
        """Three lengths with this sum, none longer than `most`."""
        found = self.triples[total]
        while self.triple_at[total] < len(found) and self.left[found[self.triple_at[total]]] <= 0:
            self.triple_at[total] += 1
        for a in found[self.triple_at[total] :]:
            if (most is None or a <= most) and self._free(a) > 0:
                self.held.append(a)
                rest = self.pair(total - a, a)
                self.held.pop()
                if rest:
                    return a, *rest
        return None

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the lengths can be taken together."""
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times


class _Open:
    """Patterns in the making by their gaps, and those without one."""

    def __init__(self) -> None:
        self.full: list[tuple[tuple[int, ...], int]] = []
        self.gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(self, lengths: tuple[int, ...], times: int, gap: int) -> None:
        self.gaps.setdefault(gap, []).append((lengths, times)) if gap else self.full.append((lengths, times))

    def add(self, gap: int, lengths: tuple[int, ...], times: int) -> int:
        """Adds lengths to one pattern with this gap, at most `times`; how often it was done."""
        held, n = self.gaps[gap].pop()
        if not self.gaps[gap]:
            del self.gaps[gap]
        used = min(n, times)
        if used < n:
            self.put(held, n - used, gap)
        self.put((*held, *lengths), used, gap - sum(lengths))
        return used

    def all(self) -> list[tuple[tuple[int, ...], int]]:
        return self.full + [p for group in self.gaps.values() for p in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of place, times used) that hold counts[l] pieces of each length l.

    Pieces over half of the capacity open a sequence each, as any plan must. The others come from the longest down: the gap that is exactly
    theirs, or one that they fill with one, two or three shorter ones, fewest first and the smallest such gap, or else the best-fitting one.
    Those that no gap had room for share sequences of their own.
    """
    index, made = SumIndex(counts), _Open()
    left, rest = index.left, np.zeros(capacity + 1, np.int64)
    for length in range(capacity, capacity // 2, -1):
        if left[length]:
            made.put((length,), int(left[length]), capacity - length)
            left[length] = 0
    for length in range(capacity // 2, 0, -1):
        while left[length] > 0:
            fitting = sorted(g for g in made.gaps if g >= length)
            if not fitting:
                rest[length], left[length] = left[length], 0
                break
            exact = ((len(found), g, found) for g in fitting if (found := index.beside(length, g)))
            _, gap, found = (0, length, ()) if fitting[0] == length else min(exact, default=(0, fitting[0], ()))
            lengths = (length, *found)
            index.take(lengths, made.add(gap, lengths, index.times(lengths)))
    return made.all() + _shared(rest, capacity)


def _shared(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of pieces of at most half the capacity, none of which has a place.

    The shortest first: all that sums to the capacity by twos, threes and fours, then the best-fitting gap from the longest down.
    """
    index, made = SumIndex(counts, upward=True), _Open()
    left = index.left
    for kind in (index.single, index.pair, index.triple):
        for length in np.flatnonzero(counts).tolist():
            while left[length] > 0:
                index.held.append(length)  # this one has the gap
                found = kind(capacity - length)
                index.held.pop()
                if found is None:
                    break
                made.put((length, *found), times := index.times((length, *found)), 0)
                index.take((length, *found), times)
    for length in np.flatnonzero(left)[::-1].tolist():
        while left[length] > 0:
            if fitting := [g for g in made.gaps if g >= length]:
                left[length] -= made.add(min(fitting), (length,), int(left[length]))
            else:
                each = min(int(left[length]), capacity // length)
                times = int(left[length]) // each
                made.put((length,) * each, times, capacity - each * length)
                left[length] -= each * times
    return made.all()


class _Places:
    """Where the n-th piece of a length goes."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> None:
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        taken = np.zeros(capacity + 1, np.int64)
        for lengths, times in patterns:
            at = 0
            for x in lengths:
                slots.setdefault(x, []).append((int(taken[x]), times, first, at))
                taken[x] += times
                at += x
            first += times
        self.slots = {x: np.array(v, np.int64) for x, v in slots.items()}

    def find(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(nth), np.int64), np.empty(len(nth), np.int64)
        for x in np.unique(length):
            own, table = length == x, self.slots[int(x)]
            row = table[np.searchsorted(table[:, 0], nth[own], side="right") - 1]
            sequence[own], offset[own] = row[:, 2] + nth[own] - row[:, 0], row[:, 3]
        return sequence, offset


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of each document: its ids, with end_id after them, in pieces of at most `capacity`.

    nth counts the pieces of the same length before it in its task's part. Null text counts as empty. Without with_ids, ids is null.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part = encoder(tokenizer_path), end_mark(end_id), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode.ids(text.as_py()) + end
                for k, (start, length) in enumerate(cut(len(ids) // 2, capacity)):
                    own = ids[2 * start : 2 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(np.frombuffer(own, "<u2").astype("<u4").tobytes()), own if with_ids else None, part, int(seen[length])))
                    seen[length] += 1
                    size += len(own)
                if size > 1 << 23:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())])


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its sequence_id and offset there; ids holds its tokens (little-endian uint16).

    Without with_ids only places are numbered, and no ids are read again or shuffled.
    Offsets in a sequence are gapless from 0. Null text counts as empty: the end id alone. Repeated rows are packed each time; null doc_ids too. A very long
    text is encoded whole, and cut after that. Empty input gives no rows. Other columns are ignored.
    """
    pieces = Scratch(spark, "packing").table(tokenize_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    sizes = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(_Places(plan(counts, capacity), capacity))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.value.find(batch["length"].to_numpy(), batch["nth"].to_numpy() + batch["before"].to_numpy())
            kept = batch.drop_columns(["part", "nth", "before"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    if not with_ids:
        pieces = pieces.drop("ids")
    before = sizes.selectExpr("part", "length", "coalesce(sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    numbered = pieces.join(before, ["part", "length"]).select(*pieces.columns, "before")
    own = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids
    return numbered.mapInArrow(placed, own + "sequence_id long, offset long")


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids (little-endian uint16) and the documents in them."""
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("parts"))
    return rows.select("sequence_id", "n_tokens", F.expr("aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.ids))").alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    return pack(spark, documents(spark, sf_dir), tokenizer_path or default_tokenizer(), with_ids=False)
