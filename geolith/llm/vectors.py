"""Vectors of Arrow batches as numpy matrices, and what the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: str) -> Column:
    """Whether the vector is there, has components, and each is a finite number."""
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows; a vector of another width is an error."""
    if len(vectors) and pc.min_max(pc.list_value_length(vectors)).as_py() != {"min": width, "max": width}:
        raise ValueError(f"vectors must have {width} components each")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lists(rows: np.ndarray) -> pa.Array:
    """A list for each row of a matrix."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1] or 1, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(rows).ravel())


def scaled(rows: np.ndarray, by: int, most: int) -> np.ndarray:
    """floor(by * x) of doubles as int64; beyond `most` on either side is an error, as sums would not be exact."""
    out = np.floor(rows.astype(np.float64) * by)
    if out.size and np.abs(out).max() > most:
        raise ValueError(f"a component of a vector is beyond {most / by:g}")
    return out.astype(np.int64)


def width_of(vectors: DataFrame, vector: str) -> int:
    """The number of components of each vector, 0 if there are none; several numbers are an error."""
    low, high = vectors.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors have from {low} to {high} components")
    return low or 0


def summed(parts: DataFrame, keys: list[str], column: str, width: int, kind: str) -> dict[tuple, list]:
    """For each key the sums of the arrays, component by component; the driver gets one row a key."""
    sums = parts.groupBy(*keys).agg(*[F.sum(F.col(column)[k].cast(kind)).alias(f"s{k}") for k in range(width)])
    return {tuple(row[: len(keys)]): list(row[len(keys) :]) for row in sums.collect()}
