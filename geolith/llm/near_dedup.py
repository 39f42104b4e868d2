"""Near-duplicate components by a multi-index Hamming join of b-bit minwise signatures.

A signature has SYMBOLS symbols of 16 bits; the share of symbols in which two texts differ estimates how
far their sets of shingles differ. Signatures within DISTANCE symbols of each other, cut into CHUNKS
chunks, agree in some chunk but for at most DISTANCE // CHUNKS symbols (pigeonhole). Each text therefore
emits a key for every chunk and every choice of that many symbols to leave out; texts within the distance
share a key for certain. At a similarity of 0.85 a pair's distance exceeds 23 of 64 with a probability
of 9e-6; every link found is confirmed on full sets.

Work is kept linear where texts abound. Equal sets are joined first and one of them goes on. Texts are dealt out by
ranges of (key, text), so that a key of many is no one task's; what a key counts in several ranges is added up. Keys of few
texts give their pairs; in keys of many, each text is first compared with the smallest alone. What
these links connect needs no further comparison, so that in those keys only pairs from different
components are left, which tasks compare block by block on whole sets, without a row for each pair compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.llm.components import components
from geolith.llm.kernels import LOWER, SPACE, Hashes, blocks, joined, mixed, runs
from geolith.llm.shared import Scratch, documents, fresh_names, partitions

WORDS, PERCENT = 5, 85
SYMBOLS, DISTANCE, CHUNKS = 64, 23, 12
#: Keys of more texts than this are compared in blocks, of at most so many texts and hashes (one text may have more).
FEW, BLOCK, BLOCK_HASHES = 8, 1024, 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240917))
_XOR = _rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BOUNDS = [SYMBOLS * k // CHUNKS for k in range(CHUNKS + 1)]
#: The symbols of each key: a chunk less every choice of DISTANCE // CHUNKS symbols.
KEYS = [kept for a, b in zip(_BOUNDS, _BOUNDS[1:]) for kept in combinations(range(a, b), b - a - DISTANCE // CHUNKS)]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text."""
    raw, first, last = joined(texts)
    starts, ends = runs(~SPACE[raw])
    hashes = Hashes(LOWER[raw]).of(starts, ends)
    lo, hi = np.searchsorted(starts, first), np.searchsorted(starts, last)
    full = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for j in range(words):
        full += hashes[j : j + len(full)] * np.uint64(2 * j * 0x9E3779B9 + 3)
    full = mixed(full)
    out = []
    for a, b in zip(lo, hi):
        if b - a >= words:
            out.append(np.unique(full[a : b - words + 1]))
        elif b > a:  # fewer words: the whole sequence is the one shingle; its length keeps it apart
            out.append(mixed((hashes[a:b] * (np.arange(b - a, dtype=np.uint64) * np.uint64(2) + np.uint64(0xABCDEF1))).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(full[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SYMBOLS symbols of 16 bits for each set, none of which is empty."""
    sizes = np.array([len(s) for s in sets])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    buffer = np.empty_like(x)
    for j in range(SYMBOLS):
        np.bitwise_xor(x, _XOR[j], out=buffer)
        np.multiply(buffer, _ODD[j], out=buffer)
        low = np.minimum.reduceat(buffer, at) * np.uint32(0x85EBCA6B)
        out[:, j] = (low ^ (low >> np.uint32(13))) >> np.uint32(16)
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each of KEYS, a row for each signature."""
    wide = signature.astype(np.uint64) + np.uint64(1)
    out = np.empty((len(signature), len(KEYS)), np.uint64)
    for k, kept in enumerate(KEYS):
        h = np.full(len(signature), k + 1, np.uint64)
        for j in kept:
            h = (h ^ wide[:, j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out[:, k] = h
    return out.view(np.int64)


def _linked(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
    return 100 * common >= PERCENT * (a + b - common)


def set_hash(shingles: np.ndarray) -> int:
    """64 bits that tell one set from another."""
    return int((mixed(shingles * np.uint64(3)).sum() ^ np.uint64(len(shingles))).view(np.int64))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, same, signature): same is a hash of the whole set, null for an empty one."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            for first, texts in blocks(batch["text"]):
                sets = shingle_sets(texts)
                some = [s for s in sets if len(s)]
                sig = iter(signatures(some)) if some else iter(())
                rows = [(len(s), set_hash(s), next(sig).tobytes()) if len(s) else (0, None, None) for s in sets]
                n, same, sigs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(same, pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "same", "signature"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, same long, signature binary")


def keyed(reps: DataFrame) -> DataFrame:
    """(key, g, n) for each key of each representative (g, n, signature)."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                own = batch.slice(at, 2000)
                keys = chunk_keys(np.frombuffer(b"".join(own["signature"].to_pylist()), np.uint16).reshape(-1, SYMBOLS))
                repeat = keys.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(own["g"].to_numpy(), repeat)), pa.array(np.repeat(own["n"].to_numpy(), repeat))], ["key", "g", "n"])

    return reps.select("g", "n", "signature").mapInArrow(explode, "key long, g long, n long")


def near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signatures differ in at most DISTANCE symbols."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, SYMBOLS) for c in ("su", "sv"))
            yield batch.select(["u", "v"]).filter(pa.array((a != b).sum(1) <= DISTANCE))

    of = lambda node, sig: reps.select(F.col("g").alias(node), F.col("signature").alias(sig))
    return pairs.join(of("u", "su"), "u").join(of("v", "sv"), "v").select("u", "v", "su", "sv").mapInArrow(close, "u long, v long")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(g, shingles) of the wanted (g, id): the sorted hashes of the set, made anew from the text of document id."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = batch["g"].to_pylist()
            for first, texts in blocks(batch["text"]):
                made = [(k, s) for k, s in zip(g[first:], shingle_sets(texts)) if len(s) and set_hash(s) == k]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.int64()), pa.array([s.tobytes() for _, s in made], pa.binary())], ["g", "shingles"])

    texts = docs.select(F.col("doc_id").alias("id"), "text")
    return texts.join(wanted, "id").select("g", "text").mapInArrow(make, "g long, shingles binary").dropDuplicates(["g"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that full sets confirm as links."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch["su"], batch["sv"], strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                ok.append(bool(_linked(_common(a, b), len(a), len(b))))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    of = lambda node, shingles: sets.select(F.col("g").alias(node), F.col("shingles").alias(shingles))
    return pairs.join(of("u", "su"), "u").join(of("v", "sv"), "v").select("u", "v", "su", "sv").mapInArrow(check, "u long, v long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the texts of one key in one or two blocks: pairs from different components that may be linked.

    Rows: key, x and y (the blocks), block, g, n, root, signature, shingles. A pair is looked at under the first
    key that it shares. Whole sets decide, and pairs that links found here already connect are left out.
    """
    x, y = int(rows["x"].iloc[0]), int(rows["y"].iloc[0])
    rows = rows.sort_values(["block", "g"], ignore_index=True)
    left, right = (np.flatnonzero(rows["block"] == k) for k in (x, y))
    signature = np.frombuffer(b"".join(rows["signature"]), np.uint16).reshape(-1, SYMBOLS)
    n, root, g, keys = rows["n"].to_numpy(), rows["root"].to_numpy(), rows["g"].to_numpy(), chunk_keys(signature)
    index = int(np.flatnonzero(keys[0] == rows["key"].iloc[0])[0])
    a, b = n[left][:, None], n[right][None, :]
    fits = (100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)) & (root[left][:, None] != root[right][None, :])
    if x == y:
        fits &= left[:, None] < right[None, :]
    i, j = np.nonzero(fits)
    i, j = left[i], right[j]
    close = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 15):
        p, q = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        close[at : at + (1 << 15)] = ((signature[p] != signature[q]).sum(1) <= DISTANCE) & (keys[p, :index] != keys[q, :index]).all(1)
    i, j = i[close], j[close]
    common = _common_many([np.frombuffer(s, np.uint64) for s in rows["shingles"]], i, j)
    linked = _linked(common, n[i], n[j])
    parent = {int(r): int(r) for r in root}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    out: list[tuple[int, int]] = []
    for p, q in zip(i[linked], j[linked], strict=True):
        if (r := find(int(root[p]))) != (s := find(int(root[q]))):
            parent[r] = s
            out.append((int(g[p]), int(g[q])))
    return pd.DataFrame(out, columns=["u", "v"]).astype({"u": "int64", "v": "int64"})


def _common_many(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[i] and sets[j]."""
    if len(i) < 200:
        return np.array([_common(sets[p], sets[q]) for p, q in zip(i, j, strict=True)], np.int64)
    owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[column] > 1)
    place = (np.cumsum(times > 1) - 1)[column[shared]]
    words = -(-int((times > 1).sum()) // 64)
    bits = np.zeros((len(sets), words), np.uint64)  # a set's members among the hashes that any two share
    np.bitwise_or.at(bits, (owner[shared], place // 64), np.uint64(1) << (place % 64).astype(np.uint64))
    out, step = np.empty(len(i), np.int64), max(1, (1 << 22) // max(words, 1))
    for at in range(0, len(i), step):
        out[at : at + step] = np.bitwise_count(bits[i[at : at + step]] & bits[j[at : at + step]]).sum(1, dtype=np.int64)
    return out


def shared_keys(reps: DataFrame, work: Scratch) -> DataFrame:
    """(key, g, n, size, lead, lead_n) of each key that several representatives have: how many they are, and the smallest with its n.

    Ranges of (key, g) are counted each by its task; only the first and last key of a range can go on in another, and what
    is counted of these, two numbers a range at most, is added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        key, g, n = (rows[c].to_numpy() for c in ("key", "g", "n"))
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        size, lead = np.repeat(sizes, sizes), np.repeat(starts, sizes)
        edge = (key == key[0]) | (key == key[-1])
        stay = np.flatnonzero((size > 1) | edge)
        for at in range(0, len(stay), 1 << 16):
            k = stay[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[k], g[k], n[k], size[k], g[lead[k]], n[lead[k]], edge[k])], ["key", "g", "n", "size", "lead", "lead_n", "edge"])

    schema = "key long, g long, n long, size long, lead long, lead_n long, edge boolean"
    dealt = keyed(reps).repartitionByRange(partitions(reps.sparkSession), "key", "g").sortWithinPartitions("key", "g")
    counted = work.table(dealt.mapInArrow(count, schema), "counted")
    own = ["key", "g", "n", "size", "lead", "lead_n"]
    cut = counted.filter("edge")
    whole = cut.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("g", "n")).alias("least")).filter("size > 1")
    # two keys for each of the session's shuffle partitions at most
    mended = cut.select("key", "g", "n").join(F.broadcast(whole), "key").select("key", "g", "n", "size", F.col("least.g").alias("lead"), F.col("least.n").alias("lead_n"))
    return counted.filter("NOT edge").select(*own).union(mended.select(*own))


def blocked(rows: DataFrame, work: Scratch) -> DataFrame:
    """rows (key, g, n, root) of the keys with several roots, and the block that each is in under its key.

    Blocks hold neighbours by size, so that those whose sizes are too far apart need not meet. Ranges of (key, n, g) are gone
    through each by its task; what comes before the first key of a range, and the roots that the first and last key have in
    others, two rows a range at most, are put together.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table, part = pa.Table.from_batches(held).combine_chunks(), TaskContext.get().partitionId()
        key, g, n, root = (table[c].to_numpy() for c in ("key", "g", "n", "root"))
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        weight = np.maximum(n, BLOCK_HASHES // BLOCK)
        before = np.cumsum(weight) - weight
        before -= np.repeat(before[starts], sizes)
        low, high = (np.repeat(f.reduceat(root, starts), sizes) for f in (np.minimum, np.maximum))
        edge = (key == key[0]) | (key == key[-1])
        stay = np.flatnonzero(edge | (low != high))
        for at in range(0, len(stay), 1 << 16):
            k = stay[at : at + (1 << 16)]
            columns = [key[k], g[k], n[k], root[k], before[k], before[k] + weight[k], low[k], high[k], edge[k], np.full(len(k), part, np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "g", "n", "root", "before", "filled", "low", "high", "edge", "part"])

    schema = "key long, g long, n long, root long, before long, filled long, low long, high long, edge boolean, part int"
    dealt = rows.select("key", "g", "n", "root").repartitionByRange(partitions(rows.sparkSession), "key", "n", "g").sortWithinPartitions("key", "n", "g")
    numbered = work.table(dealt.mapInArrow(number, schema), "numbered")
    whole = Window.partitionBy("key")
    ends = numbered.filter("edge").groupBy("key", "part").agg(F.max("filled").alias("filled"), F.min("low").alias("low"), F.max("high").alias("high"))
    ends = ends.select("key", "part", F.min("low").over(whole).alias("low"), F.max("high").over(whole).alias("high"), (F.sum("filled").over(whole.orderBy("part")) - F.col("filled")).alias("offset"))
    # two rows for each of the session's shuffle partitions at most
    mended = numbered.filter("edge").drop("low", "high").join(F.broadcast(ends.filter("low <> high").drop("low", "high")), ["key", "part"])
    placed = numbered.filter("NOT edge").withColumn("offset", F.lit(0).cast("long"))
    own = ["key", "g", "n", "root", F.floor((F.col("offset") + F.col("before")) / BLOCK_HASHES).cast("long").alias("block")]
    return placed.select(*own).union(mended.select(*own))


def crossing(many: DataFrame, roots: DataFrame, reps: DataFrame, sets: DataFrame, work: Scratch) -> DataFrame:
    """Links (u, v) of the keys of many texts between different components; see compare_blocks."""
    rows = many.select("key", "g", "n").join(roots.select(F.col("node").alias("g"), "root"), "g", "left").withColumn("root", F.coalesce("root", "g"))
    rows = work.table(blocked(work.table(rows, "split"), work), "rows")
    spans = rows.groupBy("key", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = spans.select("key", F.col("block").alias("x"), "low", "high"), spans.select("key", F.col("block").alias("y"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    meet = a.join(b, "key").filter(f"x <= y AND 100 * high >= {PERCENT} * other_low AND 100 * other_high >= {PERCENT} * low").select("key", "x", "y")
    meet = meet.select("key", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    payload = reps.select("g", "signature").join(sets, "g")
    return rows.join(payload, "g").join(meet, ["key", "block"]).groupBy("key", "x", "y").applyInPandas(compare_blocks, "u long, v long")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of (doc_id, text).

    Null text counts as empty; a text without words has an empty set, is linked with nothing and is kept. Rows
    with a null doc_id have a null component_id, link nothing and are not kept. Repeated rows get the same
    values. A very long text is read whole; that takes about 60 bytes of a task's memory for each of its own. Empty input
    gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "near_dedup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = work.table(signed(docs), "signed")
    known = rows.filter("doc_id IS NOT NULL AND same IS NOT NULL")
    reps = work.table(known.groupBy(F.col("same").alias("g")).agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")), "reps")
    keys = shared_keys(reps, work)
    many = keys.filter(F.col("size") > FEW)
    fits = f"100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)"
    few = keys.filter(F.col("size") <= FEW).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("g", "n"))).alias("l"))
    few = few.select(F.explode(F.expr(f"flatten(transform(l, (a, i) -> transform(filter(slice(l, i + 2, {FEW}), b -> {fits}), b -> struct(a.g AS u, b.g AS v))))")).alias("p")).select("p.u", "p.v")
    star = many.filter(f"g <> lead AND 100 * least(n, lead_n) >= {PERCENT} * greatest(n, lead_n)").select(F.col("lead").alias("u"), F.col("g").alias("v"))
    pairs = work.table(near(few.union(star).distinct(), reps), "pairs")
    wanted = pairs.select(F.col("u").alias("g")).union(pairs.select("v")).union(many.select("g")).distinct().join(reps.select("g", "id"), "g")
    sets = work.table(full_sets(docs, wanted), "sets")
    links = work.table(confirmed(pairs, sets), "links")
    roots = work.table(components(links, work, "first"), "roots")
    found = work.table(crossing(many, roots, reps, sets, work), "found")
    if not found.isEmpty():
        roots = work.table(components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found), work, "last"), "all_roots")
    work.drop("counted", "pairs", "sets", "links", "split", "numbered", "rows", "found")  # what is returned reads none of these
    placed = reps.select("g", "id").join(roots.select(F.col("node").alias("g"), "root"), "g", "left").withColumn("root", F.coalesce("root", "g"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    of = placed.join(least, "root").select(F.col("g").alias("same"), "component_id")
    mine = F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = rows.select("doc_id", "n_shingles", "same").join(of, "same", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), mine).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, with all its columns.

    Rows that share the doc_id that stays all stay; rows with a null doc_id go.
    """
    [key] = fresh_names(1)
    stay = near_components(docs).filter("kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, F.col("doc_id").cast("long")).join(stay, key, "left_semi").select(*docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT u, v FROM c JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 85 * (a.n + b.n - k)
), e AS (
  SELECT u, v FROM l UNION ALL SELECT v, u FROM l
), r AS (
  SELECT u AS node, u AS root FROM e UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node
), m AS (
  SELECT node, min(root) AS root FROM r GROUP BY node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, coalesce(m.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.node = d.doc_id
"""
