"""Embedding whitening: leading components of the covariance without forming it, and rows of unit variance in them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from geolith.llm.shared import Scratch, documents, fresh_names
from geolith.llm.vectors import lists, matrix, scaled, summed, whole, width_of

#: Components become floor(SCALE * c) + SHIFT; up to MOST, sums stay exact.
SCALE, SHIFT, MOST = 64, 1_000_000, 1 << 40
COMPONENTS = 32
#: A residual |Vq - eq| certifies a component up to CLOSE of its eigenvalue, or FLOOR of the largest, which is what rounding leaves.
CLOSE, FLOOR = 1e-11, 2.0**-46
#: Of the largest eigenvalue; components below have no variance that doubles could tell from none.
LEAST = 1e-12
#: A pass that brings the worst residual down by less than this doubles the block.
GAIN = 8
SEED = 11


@dataclass(frozen=True)
class Fit:
    """What rows are centred by and projected on: sums are n * base + rest; the columns of `components` are unit eigenvectors."""

    n: int
    base: np.ndarray
    rest: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Of each row the sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        y, n, rest = x - self.base, self.n, self.rest
        most = int(np.abs(y).max(initial=0)) * n + n
        if x.shape[1] * most * most < 1 << 63:
            each = n * y - np.array(rest, np.int64)
            return (each * each).sum(1).tolist()
        exact = (sum((n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def _sums(rows: DataFrame, x: str, width: int) -> tuple[int, list[int]]:
    """The number of rows and exact sums of each dimension."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = matrix(batch.column(0), width)
            if len(held):
                yield pa.RecordBatch.from_arrays([lists(np.concatenate([[len(held)], held.sum(0)])[None, :])], ["sums"])

    n, *sums = summed(rows.select(x).mapInArrow(totals, "sums array<bigint>"), [], "sums", width + 1, "decimal(38,0)").get((), [None])
    return int(n or 0), [int(s) for s in sums if s is not None]


def _summed_products(rows: DataFrame, x: str, width: int, made: int, columns: int, product) -> np.ndarray:
    """The sum over batches of product(matrix of the batch), a matrix of (made, columns): each task adds its own up, a grouped shuffle merges them by row."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((made, columns))
        for batch in batches:
            held += product(matrix(batch.column(0), width))
        yield pa.RecordBatch.from_arrays([np.arange(made, dtype=np.int32), lists(held)], ["i", "sums"])

    found = summed(rows.select(x).mapInArrow(totals, "i int, sums array<double>"), ["i"], "sums", columns, "double")
    return np.array([found[i,] for i in range(made)])


def fit(rows: DataFrame, x: str, width: int, k: int = COMPONENTS, block: int | None = None) -> Fit | None:
    """The first k components of the covariance of all rows, by block subspace iteration; None without rows.

    A pass over the rows computes X'(XQ) for centred rows and a block Q of orthonormal columns, never the
    covariance. The driver, which holds matrices of (width, block) alone, rotates Q to Ritz vectors. Residuals of this very pass
    certify them, or Q goes on as the QR factor of the product. Where eigenvalues beyond the block are too near, so that passes
    gain little, the block doubles by random columns; at full width a pass is exact, so the iteration ends.
    """
    n, sums = _sums(rows, x, width)
    if not n:
        return None
    base = [s // n for s in sums]
    out = Fit(n, np.array(base, np.int64), [s - n * b for s, b in zip(sums, base, strict=True)], np.zeros((width, 0)), np.zeros(0), 0.0)
    rng = np.random.Generator(np.random.PCG64(SEED))
    k = min(k, width)
    q = np.linalg.qr(rng.standard_normal((width, min(width, block or 2 * k))))[0]
    before = np.inf
    while True:

        def product(held: np.ndarray, q=q) -> np.ndarray:
            centred = out.centred(held)
            squares = np.zeros((1, q.shape[1]))
            squares[0, 0] = (centred * centred).sum()
            return np.concatenate([centred.T @ (centred @ q), squares])

        made = _summed_products(rows, x, width, width + 1, q.shape[1], product) / n
        image, trace = made[:-1], made[-1, 0]
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, image = q @ turn, image @ turn
        off = np.linalg.norm(image - vectors * values, axis=0)
        wanted = np.arange(len(values)) < k
        sure = off <= np.maximum(CLOSE * values, FLOOR * values[0])
        if trace == 0 or sure[wanted].all() or q.shape[1] == width:
            found = wanted & (values > LEAST * values[0]) & (values > 0)
            signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
            return Fit(n, out.base, out.rest, (vectors * signs)[:, found], values[found], trace)
        worst = (off / np.maximum(values, values[0] * FLOOR))[wanted].max()
        q = np.linalg.qr(image)[0]
        if worst * GAIN > before and q.shape[1] < width:
            more = rng.standard_normal((width, min(q.shape[1], width - q.shape[1])))
            q, worst = np.linalg.qr(np.concatenate([q, more], 1))[0], np.inf
        before = worst


def whiten(spark: SparkSession, vectors: DataFrame, key: str, vector: str = "embedding", k: int = COMPONENTS, block: int | None = None) -> DataFrame:
    """For each row and component: key, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds a null or non-finite component are dropped; all others are fitted and returned, null keys and
    repeated rows included. Components without variance are left out: identical rows, or a single one, give no rows, and neither does an empty
    table. Other columns of `vectors` are not read. deviation is null where it exceeds 64 bits. Vectors must be equally long,
    with no component beyond 2^34; else a ValueError tells so.
    """
    work = Scratch(spark, "whitening")
    (x,) = fresh_names(1)
    kept = vectors.select(F.col(key).alias("k"), F.col(vector).alias("v")).filter(whole("v"))
    width = width_of(kept, "v")

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(scaled(matrix(batch.column(1), width), SCALE, MOST) + SHIFT)], ["k", x])

    rows = work.table(kept.mapInArrow(integers, kept.select("k").schema.add(x, ArrayType(LongType()))), "integers")
    found = fit(rows, x, width, k, block)
    schema = kept.select(F.col("k").alias(key)).schema
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    many = 0 if found is None else len(found.values)
    if not many:
        return spark.createDataFrame([], schema)

    def squares(held: np.ndarray) -> np.ndarray:
        out = found.whitened(held)
        return out.T @ out

    error = float(np.abs(_summed_products(rows, x, width, many, many, squares) / found.n - np.eye(many)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 2048) for at in range(0, batch.num_rows, 2048)):
                held = matrix(part.column(1), width)
                m = len(held)
                each = np.repeat(np.arange(m), many)
                columns = [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), m)), pa.array(np.full(m * many, found.n)), pa.array(found.deviations(held), pa.int64()).take(pa.array(each))]
                columns += [pa.array(found.whitened(held).ravel()), pa.array(np.tile(found.values / found.trace, m)), pa.array(np.full(m * many, error))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(out, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the leading 32 components of their covariance, each with unit variance."""
    return whiten(spark, documents(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")
