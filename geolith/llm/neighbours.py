"""Approximate nearest neighbours: balanced posting lists whose centroids are searched by a graph in memory."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geolith.llm.shared import Scratch, documents
from geolith.llm.vectors import matrix, whole, width_of

#: Distinct vectors that a list has on average, and the most lists there are: this bounds what is broadcast. Beyond LISTS * LIST_ROWS vectors, lists
#: grow longer and are searched in blocks.
LIST_ROWS, LISTS = 200, 16384
#: Rows of a list, or queries of a list, that one group of the search holds; longer lists are dealt out in blocks of about so many.
BLOCK_ROWS = 4096
#: The lists are fitted on a sample of this many rows a list, within so many bytes.
SAMPLE_A_LIST, SAMPLE_BYTES = 32, 32 << 20
#: A vector stands in up to REPLICAS lists whose centroids are at most (1 + CLOSURE) times as far as its nearest.
REPLICAS, CLOSURE = 2, 0.05
#: At least so many lists are searched for a query. Others are pruned by the ratio of their distance to the nearest one's, which is set so that
#: this share of the sample's own neighbours is found.
LEAST_LISTS, RECALL = 8, 0.95
NEAREST = 10
#: Of the centroids' graph: links to nearest ones and to any ones, and nodes where a search starts.
NEAR_LINKS, FAR_LINKS, STARTS = 24, 8, 16
#: Cells of the table of distances, a row for each vector, that a search keeps at a time.
CELLS = 1 << 21
SEED = 12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, but for rounding."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1), 0)


def balanced(points: np.ndarray, leaves: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of as many groups of equal size: each group is cut in two across the line between two means, where the numbers of leaves ask for it."""
    out, todo = [], [(np.arange(len(points)), leaves)]
    while todo:
        at, n = todo.pop()
        held = points[at]
        if n == 1:
            out.append(held.mean(0))
            continue
        pair = held[rng.choice(len(at), 2, replace=False)]
        for _ in range(4):
            first = squared(held, pair).argmin(1) == 0
            if first.all() or not first.any():
                break
            pair = np.stack([held[first].mean(0), held[~first].mean(0)])
        order = np.argsort(held @ (pair[1] - pair[0]), kind="stable")
        cut = max(n // 2, min(len(at) - (n - n // 2), len(at) * (n // 2) // n))
        todo += [(at[order[:cut]], n // 2), (at[order[cut:]], n - n // 2)]
    return np.array(out)


@dataclass(frozen=True)
class Centroids:
    """The lists' centroids with a graph over them, and the ratio by which lists are pruned."""

    points: np.ndarray
    links: np.ndarray
    starts: np.ndarray
    ratio: float

    @staticmethod
    def linked(points: np.ndarray, rng: np.random.Generator) -> Centroids:
        """Each centroid is linked to its nearest ones and, so that all can be reached, to the next one in order and some others."""
        n = len(points)
        near = min(NEAR_LINKS, n - 1)
        links = [np.argpartition(squared(points[at : at + 1024], points), near, axis=1)[:, : near + 1] for at in range(0, n, 1024)]
        far = np.concatenate([(np.arange(n)[:, None] + 1) % n, rng.integers(0, n, (n, FAR_LINKS))], 1)
        return Centroids(points, np.concatenate([np.concatenate(links), far], 1), rng.choice(n, min(STARTS, n), replace=False), 1.0)

    def search(self, x: np.ndarray, least: int, ratio: float) -> np.ndarray:
        """Squared distances (vector, centroid) as far as the graph is walked: the `least` nearest found, and all within `ratio` of the nearest.

        All vectors walk at once. Those nodes are expanded that are among the nearest found so far, then those within the ratio;
        what is not reached stays infinite.
        """
        n, many = len(x), len(self.points)
        found, open_ = np.full((n, many), np.inf), np.ones((n, many), bool)
        norms = (self.points * self.points).sum(1)
        own = (x * x).sum(1)
        found[:, self.starts] = squared(x, self.points[self.starts])
        least = min(max(least, 1), many)
        while True:
            limit = np.partition(found, least - 1, axis=1)[:, least - 1]
            row, node = np.nonzero(open_ & (found <= limit[:, None]) & np.isfinite(found))
            if not len(row):
                row, node = np.nonzero(open_ & (found <= (ratio * ratio * found.min(1))[:, None]))
            if not len(row):
                return found
            open_[row, node] = False
            pairs = np.unique((row[:, None] * many + self.links[node]).ravel())
            row, node = np.divmod(pairs[np.isinf(found.ravel()[pairs])], many)
            for at in range(0, len(row), 1 << 16):
                r, c = row[at : at + (1 << 16)], node[at : at + (1 << 16)]
                found[r, c] = np.maximum(own[r] - 2 * np.einsum("ij,ij->i", x[r], self.points[c]) + norms[c], 0)

    def batches(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        size = max(1, CELLS // len(self.points))
        for at in range(0, len(x), size):
            yield at, x[at : at + size]

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the nearest list of each vector, and for one near a boundary further ones."""
        rows, found = [], []
        for at, part in self.batches(x):
            away = self.search(part, REPLICAS, 1 + CLOSURE)
            many = min(REPLICAS, away.shape[1])
            near = np.argpartition(away, many - 1, axis=1)[:, :many]
            near = np.take_along_axis(near, np.argsort(np.take_along_axis(away, near, 1), axis=1, kind="stable"), 1)
            away = np.take_along_axis(away, near, 1)
            taken = away <= (1 + CLOSURE) ** 2 * away[:, :1]
            row, place = np.nonzero(taken)
            rows.append(row + at)
            found.append(near[row, place])
        return np.concatenate(rows), np.concatenate(found)

    def wanted(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the lists that are searched for each vector."""
        rows, found = [], []
        for at, part in self.batches(x):
            away = self.search(part, LEAST_LISTS, self.ratio)
            least = min(LEAST_LISTS, away.shape[1])
            limit = np.maximum(np.partition(away, least - 1, axis=1)[:, least - 1], self.ratio**2 * away.min(1))
            row, node = np.nonzero(away <= limit[:, None])
            rows.append(row + at)
            found.append(node)
        return np.concatenate(rows), np.concatenate(found)


def fitted(sample: np.ndarray, lists: int, nearest: int = NEAREST) -> Centroids:
    """Lists for the sample, and the least ratio at which searches among it find RECALL of its vectors' true neighbours."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    out = Centroids.linked(balanced(sample, max(1, min(lists, len(sample))), rng), rng)
    asked = sample[rng.choice(len(sample), min(256, len(sample)), replace=False)]
    row, home = out.homes(sample)
    order = np.argsort(row, kind="stable")
    row, home = row[order], home[order]
    starts = np.searchsorted(row, np.arange(len(sample) + 1))
    needed = []
    for at in range(0, len(asked), 32):
        part = asked[at : at + 32]
        away, ways = squared(part, sample), np.sqrt(squared(part, out.points))
        ways /= np.maximum(ways.min(1, keepdims=True), 1e-300)
        many = min(nearest + 1, len(sample))
        for k, near in enumerate(np.argpartition(away, many - 1, axis=1)[:, :many]):
            needed += [ways[k, home[starts[i] : starts[i + 1]]].min() for i in near]
    ratio = np.quantile(needed, RECALL, method="higher")
    return Centroids(out.points, out.links, out.starts, float(min(ratio, 1e6)))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of a to those rows of b, components added in order."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += (a[:, j] - b[:, j]) ** 2
    return np.sqrt(out)


def _points(vectors: DataFrame, key: str, vector: str, copies: int) -> DataFrame:
    """(pid, v, members): distinct vectors with the smallest keys of their rows, as many as a result can hold.

    Ranks are cut in each task before rows meet, so that copies of one vector do not gather.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull() & whole("v")).filter(F.exists("v", lambda x: x != 0))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = rows.dropDuplicates(["id", "v"]).withColumn("place", place).filter(F.col("place") <= copies)
    return least.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("members")).select(F.col("members")[0].alias("pid"), "v", "members")


@dataclass(frozen=True)
class PostingIndex:
    """Distinct vectors (pid, v, members), posting lists (list, pid, v) of them, and the centroids."""

    points: DataFrame
    postings: DataFrame
    centroids: Centroids
    width: int
    nearest: int


def build(spark: SparkSession, vectors: DataFrame, key: str, vector: str = "embedding", nearest: int = NEAREST) -> PostingIndex | None:
    """Fits lists on a bounded sample and puts every vector into its lists; None where no row has a key and a whole vector that is not zero.

    Rows of one key and vector count once. A key whose rows differ in their vectors stands for each of them.
    """
    work = Scratch(spark, "neighbours")
    points = work.table(_points(vectors, key, vector, nearest + 1), "points")
    many, width = points.count(), width_of(points, "v")
    if not many:
        return None
    lists = max(1, min(LISTS, many // LIST_ROWS))
    wanted = max(2 * LEAST_LISTS, min(SAMPLE_A_LIST * max(lists, 64), SAMPLE_BYTES // (8 * width)))
    share = min(1.0, wanted / many)
    # about so many, chosen by a hash of the key; a stronger bound than chance is not needed for the driver's memory
    sampled = points.filter(F.pmod(F.xxhash64("pid", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30))).select("pid", "v").toArrow().combine_chunks().sort_by("pid")
    if not len(sampled):
        sampled = points.orderBy("pid").limit(wanted).select("pid", "v").toArrow().combine_chunks()
    sample = np.concatenate([matrix(chunk, width) for chunk in sampled.column("v").chunks]).astype(np.float64)
    centroids = fitted(sample, lists, nearest)
    sent = spark.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, home = sent.value.homes(matrix(batch.column(1), width).astype(np.float64))
                again = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32)), again.column(0), again.column(1)], ["list", "pid", "v"])

    kind = points.schema["v"].dataType.simpleString()
    postings = work.table(points.select("pid", "v").mapInArrow(place, f"list int, pid bigint, v {kind}"), "postings")
    return PostingIndex(points, postings, centroids, width, nearest)


def _dealt(rows: DataFrame, hashed: str) -> DataFrame:
    """(list, blocks): into how many blocks the rows of each list go. There are at most LISTS rows."""
    return rows.groupBy("list").agg(F.ceil(F.count(hashed) / BLOCK_ROWS).cast("int").alias("blocks"))


def search(spark: SparkSession, index: PostingIndex, asked: DataFrame) -> DataFrame:
    """(v, found): of each distinct vector v of `asked`, an array of (score, vec_id), the nearest + 1 least ones in order, its own rows included.

    Vectors and lists meet in groups of a block of a list and a block of the queries that want it, so that neither a long list nor
    a list that many want is one task's; each group keeps the nearest alone.
    """
    width, most = index.width, index.nearest + 1
    sent = spark.sparkContext.broadcast(index.centroids)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, home = sent.value.wanted(matrix(batch.column(1), width).astype(np.float64))
                for at in range(0, len(row), 8192):
                    again = batch.take(pa.array(row[at : at + 8192]))
                    yield pa.RecordBatch.from_arrays([pa.array(home[at : at + 8192].astype(np.int32)), again.column(0), again.column(1)], ["list", "qid", "q"])

    kind = index.points.schema["v"].dataType.simpleString()
    queries = index.points.join(asked.select(F.col("v").alias("asked_v")).distinct(), F.col("v") == F.col("asked_v"), "left_semi").select(F.col("pid").alias("qid"), F.col("v").alias("q"))
    work = Scratch(spark, "neighbour-search")
    queries = work.table(queries, "queries")
    ways = work.table(queries.mapInArrow(choose, f"list int, qid bigint, q {kind}"), "wanted")
    posts = index.postings.join(F.broadcast(_dealt(index.postings, "pid")), "list").withColumn("block", F.pmod(F.xxhash64("pid", F.lit(1)), F.col("blocks"))).drop("blocks")
    ways_dealt, posts_dealt = _dealt(ways, "qid"), _dealt(index.postings, "pid")
    left = posts.join(F.broadcast(ways_dealt), "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("list", "block", "part", "pid", "v")
    right = ways.join(F.broadcast(ways_dealt), "list").withColumn("part", F.pmod(F.xxhash64("qid", F.lit(1)), F.col("blocks")).cast("int")).drop("blocks")
    right = right.join(F.broadcast(posts_dealt), "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("list", F.col("block").cast("bigint").alias("block"), "part", "qid", "q")

    def compare(posts: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if posts.num_rows and asked.num_rows:
            held = matrix(posts.column("v").combine_chunks(), width).astype(np.float64)
            ids, qids = posts.column("pid").to_numpy(), asked.column("qid").to_numpy()
            wanted = matrix(asked.column("q").combine_chunks(), width).astype(np.float64)
            for at in range(0, len(wanted), 256):
                q = wanted[at : at + 256]
                away = squared(q, held)
                k = min(most, len(ids)) - 1
                limit = np.partition(away, k, axis=1)[:, k]
                # rounding of the expansion is far below this slack; distances proper decide
                row, col = np.nonzero(away <= (limit + 1e-9 * ((q * q).sum(1) + limit))[:, None])
                score = exact(q[row], held[col])
                order = np.lexsort([ids[col], score, row])
                row, col, score = row[order], col[order], score[order]
                first = np.arange(len(row)) - np.searchsorted(row, row) < most
                out.append((qids[at + row[first]], ids[col[first]], score[first]))
        parts = [np.concatenate(p) for p in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"qid": parts[0], "pid": parts[1], "score": parts[2]})

    by = ("list", "block", "part")
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, "qid bigint, pid bigint, score double")
    best = Window.partitionBy("qid").orderBy("score", "pid")
    # a vector's copies in several lists share a rank
    near = near.withColumn("place", F.dense_rank().over(best)).filter(F.col("place") <= most).groupBy("qid", "pid").agg(F.min("score").alias("score"))
    members = near.join(index.points.select("pid", "members"), "pid").select("qid", F.transform("members", lambda m: F.struct(F.col("score").alias("score"), m.alias("vec_id"))).alias("m"))
    found = members.groupBy("qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("m"))), 1, most).alias("found"))
    return found.join(queries, "qid").select(F.col("q").alias("v"), "found")


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, key: str, asked: DataFrame, vector: str = "embedding", nearest: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows of `asked`, a part of `vectors`, the nearest rows of other keys by Euclidean distance.

    Ties go to the smaller key. Rows with a null key take no part, nor do vectors that are null, empty, zero or hold a null or non-finite component. Repeated rows
    count once; a key with several vectors is a query, and may be found, for each of them. A query of an only row gets no rows, and
    an empty table gives none. Other columns are not read. Vectors must be equally long; else a ValueError tells so.
    """
    index = build(spark, vectors, key, vector, nearest)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    queries = asked.select(F.col(key).cast("bigint").alias("query_id"), F.col(vector).alias("v")).filter(F.col("query_id").isNotNull() & whole("v")).distinct()
    found = search(spark, index, queries)
    others = F.slice(F.filter("found", lambda m: m["vec_id"] != F.col("query_id")), 1, nearest)
    return queries.join(found, "v").select("query_id", F.posexplode(others).alias("place", "m")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("m.vec_id").alias("vec_id"), F.col("m.score").alias("score"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of each embedding whose vec_id is divisible by 100."""
    rows = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(spark, rows, "vec_id", rows.filter(F.col("vec_id") % 100 == 0))


#: Exact neighbours. The search equals them where all lists are searched, as for tables of up to (LEAST_LISTS + 1) * LIST_ROWS - 1 rows.
ORACLE_SQL = """
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score FROM kept q JOIN kept c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM scored)
SELECT query_id, place::INT AS rank, vec_id, score FROM placed WHERE place <= 10
"""
