"""Ring operations that take a loop over vertices, as Arrow-batched functions; each works on one ring at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"


def _points(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], np.float64).reshape(-1, 2)


def _ring(points: np.ndarray) -> list[dict]:
    return [{"x": float(x), "y": float(y)} for x, y in points]


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise from the leftmost lowest point."""
    ordered = np.unique(points, axis=0)
    if len(ordered) < 3:
        return ordered
    half = []
    for sweep in (ordered, ordered[::-1]):
        chain: list[np.ndarray] = []
        for p in sweep:
            while len(chain) >= 2 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        half += chain[:-1]
    return np.array(half)


def least_rectangle(points: np.ndarray) -> tuple[float, float, float]:
    """(area, bearing of the long side in degrees from the x axis, its length) of the smallest rectangle around the points."""
    h = hull(points)
    if len(h) < 3:
        d = h[-1] - h[0] if len(h) == 2 else np.zeros(2)
        return 0.0, float(np.degrees(np.arctan2(d[1], d[0])) % 180), float(np.hypot(*d))
    d = np.roll(h, -1, 0) - h
    a = np.arctan2(d[:, 1], d[:, 0])
    along, across = np.stack([np.cos(a), np.sin(a)], 1) @ h.T, np.stack([-np.sin(a), np.cos(a)], 1) @ h.T
    w, b = np.ptp(along, axis=1), np.ptp(across, axis=1)
    k = int(np.argmin(w * b))
    return float(w[k] * b[k]), float(np.degrees(a[k] + (np.pi / 2 if b[k] > w[k] else 0)) % 180), float(max(w[k], b[k]))


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on a line: vertices farther than the tolerance from the chord stay."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    spans = [(0, len(points) - 1)]
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        d = points[b] - points[a]
        rel = points[a + 1 : b] - points[a]
        size = np.hypot(*d)
        off = np.abs(rel[:, 0] * d[1] - rel[:, 1] * d[0]) / size if size else np.hypot(rel[:, 0], rel[:, 1])
        k = int(np.argmax(off))
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            spans += [(a, a + 1 + k), (a + 1 + k, b)]
    return points[keep]


def _hulls(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hulls, sizes) of rings (m, n, 2) as hull() gives them, filled up with the first vertex."""
    m, n = points.shape[:2]
    order = np.lexsort((points[:, :, 1], points[:, :, 0]), axis=1)
    p, rows = np.take_along_axis(points, order[:, :, None], 1), np.arange(m)
    again = np.zeros((m, n), bool)
    again[:, 1:] = (p[:, 1:] == p[:, :-1]).all(2)
    out, sizes = np.zeros((m, 2 * n + 1, 2)), np.zeros(m, int)
    for sweep in (range(n), range(n - 1, -1, -1)):
        chain, held = np.zeros((m, n, 2)), np.zeros(m, int)
        for k in sweep:
            q = p[:, k]
            at = rows[~again[:, k]]
            added = at
            while len(at):  # rings whose last vertex makes no turn to the left lose it
                at = at[held[at] >= 2]
                u, v = chain[at, held[at] - 2], chain[at, held[at] - 1]
                at = at[(v[:, 0] - u[:, 0]) * (q[at, 1] - u[:, 1]) - (v[:, 1] - u[:, 1]) * (q[at, 0] - u[:, 0]) <= 0]
                held[at] -= 1
            chain[added, held[added]] = q[added]
            held[added] += 1
        for k in range(n):
            at = rows[k < held - 1]
            out[at, sizes[at]] = chain[at, k]
            sizes[at] += 1
    spare = np.arange(2 * n + 1) >= sizes[:, None]
    return np.where(spare[:, :, None], out[:, :1], out)[:, : max(1, sizes.max()) + 1], sizes


def least_rectangles(points: np.ndarray) -> np.ndarray:
    """(m, 3): least_rectangle() of each of m rings of the same number of vertices, (m, n, 2), all finite."""
    h, sizes = _hulls(points)
    d = h[:, 1:] - h[:, :-1]
    out, rows = np.zeros((len(h), 3)), np.arange(len(h))
    a = np.arctan2(d[:, :, 1], d[:, :, 0])
    turned = h[:, :-1].transpose(0, 2, 1)
    w, b = (np.ptp(np.stack(v, 2) @ turned, axis=2) for v in ((np.cos(a), np.sin(a)), (-np.sin(a), np.cos(a))))
    k = np.argmin(np.where(np.arange(d.shape[1]) < sizes[:, None], w * b, np.inf), 1)
    w, b, a = w[rows, k], b[rows, k], a[rows, k]
    out[:] = np.stack([w * b, np.degrees(a + np.where(b > w, np.pi / 2, 0)) % 180, np.maximum(w, b)], 1)
    flat = sizes < 3
    line = np.where((sizes == 2)[:, None], d[:, 0], 0.0)[flat]
    out[flat] = np.stack([np.zeros(len(line)), np.degrees(np.arctan2(line[:, 1], line[:, 0])) % 180, np.hypot(line[:, 0], line[:, 1])], 1)
    return out


#: Rings of more vertices are worked on one by one; fewer, together with those of as many, in blocks of so many numbers.
TOGETHER, BLOCK = 64, 2_000_000


def bounding_rectangle(ring: Column) -> Column:
    """area, bearing and length of the smallest rectangle; null for a ring without vertices."""

    @F.arrow_udf("area double, bearing double, length double")
    def f(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rings in batches:
            sizes = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
            flat = rings.flatten()
            xy = np.stack([pc.cast(pc.struct_field(flat, c), pa.float64()).to_numpy(zero_copy_only=False) for c in "xy"], 1)
            start, found = np.cumsum(sizes) - sizes, np.zeros((len(sizes), 3))
            for n in np.unique(sizes[sizes > 0]):
                same = np.flatnonzero(sizes == n)
                points = xy[start[same][:, None] + np.arange(n)]
                plain = np.isfinite(points).all((1, 2)) & (n <= TOGETHER)
                step = max(1, BLOCK // int(4 * n * n))
                together = np.flatnonzero(plain)
                for k in range(0, len(together), step):
                    at = together[k : k + step]
                    found[same[at]] = least_rectangles(points[at])
                for k in np.flatnonzero(~plain):
                    found[same[k]] = least_rectangle(points[k])
            none = pa.array(sizes == 0)
            yield pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], ["area", "bearing", "length"], mask=none)

    return f(ring)


def simplify(ring: Column, tolerance: float) -> Column:
    """The ring, as a line from its first vertex back to it, simplified; without the closing vertex."""

    @F.pandas_udf(RING)
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rings in batches:
            out = []
            for r in rings:
                p = _points(r) if r is not None else np.zeros((0, 2))
                out.append(_ring(simplified(np.concatenate([p, p[:1]]), tolerance)[:-1]) if len(p) > 2 else _ring(p))
            yield pd.Series(out)

    return f(ring)


def noise(i: Column, j: Column, cell: int, seed: int) -> Column:
    """Value noise from 0 to 1: a hash at each lattice point, bilinear between. The same on any partitioning."""
    a, b = F.floor(i / cell), F.floor(j / cell)
    fi, fj = i / cell - a, j / cell - b
    at = lambda y, x: F.pmod(F.xxhash64(F.lit(seed), y.cast("long"), x.cast("long")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    low, high = at(a, b) * (1 - fj) + at(a, b + 1) * fj, at(a + 1, b) * (1 - fj) + at(a + 1, b + 1) * fj
    return low * (1 - fi) + high * fi
