"""Operators on vectors against plain numpy, on hard rows: nulls, repeats, ties, copies, clashing columns, empty tables."""

import hashlib

import numpy as np
import pytest

from geolith.llm import neighbours, vector_codes, vectors, whitening

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, code INT, error STRING, k STRING, v STRING"


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], label, 7, "x", "k", "v") for i, e, label in rows], SCHEMA).repartition(3)


def hard(seed=3, n=240, width=16):
    """Vectors of which a third are copies of one, with rows that must go, null and repeated keys, and null labels."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, width)).astype(np.float32)
    base[: n // 3] = base[0]
    rows = [(k + 5, base[k].tolist(), (k % 4) or None) for k in range(n)]
    rows += [rows[3], rows[-1], rows[-1], (None, base[7].tolist(), 1), (2, None, 1), (3, [], None), (4, [None] * width, 2), (1, [float("nan")] * width, 2), (0, [float("inf"), *[0.0] * (width - 1)], 2)]
    return rows


def kept(rows):
    return [r for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]


# ---- whitening


def centred(rows):
    x = np.floor(64 * np.array([r[1] for r in kept(rows)], np.float32).astype(np.float64)) + 1_000_000
    return x, x - x.mean(0)


@pytest.mark.parametrize("k,block", [(5, 6), (8, 16), (32, None)])
def test_whitening(spark, k, block):
    rows = hard()
    got = whitening.whiten(spark, table(spark, rows), "vec_id", k=k, block=block).toPandas()
    x, c = centred(rows)
    n, many = len(x), min(k, 16)
    assert len(got) == n * many and set(got.n) == {n}
    values, parts = np.linalg.eigh(c.T @ c / n)
    values, parts = values[::-1][:many], parts[:, ::-1][:, :many]
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    share = got.groupby("component").explained.first()
    assert np.allclose(share.to_numpy(), values / (c * c).sum() * n, rtol=1e-9)
    xi, total = x.astype(int), x.astype(int).sum(0)
    want = {}
    for row, key in zip(range(n), [r[0] for r in kept(rows)], strict=True):
        want.setdefault(key, []).append((sum(int(n * a - s) ** 2 for a, s in zip(xi[row], total, strict=True)), c[row] @ parts / np.sqrt(values)))
    for key, group in got.groupby("vec_id", dropna=False):
        w = want[None if np.isnan(key) else int(key)]
        assert set(group.deviation) == {d for d, _ in w}
        assert sorted(group.component) == sorted(list(range(1, many + 1)) * len(w))
        one = group.drop_duplicates("component").sort_values("component").whitened.to_numpy()
        assert np.allclose(np.abs(one), np.abs(w[0][1]), atol=1e-7)


def test_whitening_passes_until_certain(spark):
    """A block of 4 in 60 dimensions: near eigenvalues take several passes and larger blocks, and end as certain."""
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((300, 60)) * np.linspace(3, 1, 60)).astype(np.float32)
    rows = vectors_rows(spark, np.floor(64.0 * x.astype(float)).astype(int) + 1_000_000)
    found = whitening.fit(rows, "x", 60, 3, 4)
    c = np.floor(64.0 * x.astype(float))
    c -= c.mean(0)
    values, parts = np.linalg.eigh(c.T @ c / 300)
    assert np.allclose(found.values, values[::-1][:3], rtol=1e-12)
    assert np.allclose(np.abs((found.components * parts[:, ::-1][:, :3]).sum(0)), 1, atol=1e-12)


def vectors_rows(spark, x):
    return spark.createDataFrame([(r,) for r in x.tolist()], "x ARRAY<BIGINT>").repartition(3)


def test_whitening_without_variance(spark):
    assert whitening.whiten(spark, table(spark, []), "vec_id").count() == 0
    assert whitening.whiten(spark, table(spark, [(1, [1.0, 2.0], 0)]), "vec_id").count() == 0
    assert whitening.whiten(spark, table(spark, [(k, [1.0, 2.0], 0) for k in range(5)]), "vec_id").count() == 0
    flat = whitening.whiten(spark, table(spark, [(k, [k, 2.0, -k], 0) for k in range(5)]), "vec_id").collect()
    assert len(flat) == 5 and {r["component"] for r in flat} == {1} and flat[0]["explained"] == pytest.approx(1)
    with pytest.raises(ValueError, match="from 1 to 2"):
        whitening.whiten(spark, table(spark, [(1, [1.0, 2.0], 0), (2, [1.0], 0)]), "vec_id")


def test_deviation_beyond_64_bits():
    fit = whitening.Fit(10**9, np.array([5, 5]), [1, 0], np.zeros((2, 0)), np.zeros(0), 1.0)
    assert fit.deviations(np.array([[6, 5], [10**6, 0]])) == [(10**9 - 1) ** 2, None]


# ---- vector codes


def plain_codes(rows):
    rows = sorted(kept(rows), key=lambda r: (r[0] is None, r[0], r[1]))
    x = [[int(np.floor(4096 * float(np.float32(c)))) for c in r[1]] for r in rows]
    width = len(x[0]) // 8
    part = lambda row, p: row[p * width : (p + 1) * width]
    books = [[part(row, p) for row in x[:16]] for p in range(8)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(6):
        for p in range(8):
            groups = {}
            for row in x:
                groups.setdefault(near(part(row, p), books[p])[1], []).append(part(row, p))
            for e, held in groups.items():
                books[p][e] = [sum(c) // len(held) for c in zip(*held, strict=True)]
    out, by_label = [], {}
    for r, row in zip(rows, x, strict=True):
        ends = [near(part(row, p), books[p]) for p in range(8)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in ends), sum(d for d, _ in ends), r[2]))
        by_label[r[2]] = by_label.get(r[2], 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, code, error, label in out), key=str)


@pytest.mark.parametrize("n", [240, 9])
def test_vector_codes(spark, tmp_path, n):
    rows = hard(n=n)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vector_codes.op13_vector_codes(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(rows)


def test_vector_codes_keep_columns(spark):
    coded, books = vector_codes.encode(spark, table(spark, hard()), "vec_id", parts=4, entries=3, rounds=1)
    assert coded.columns == ["vec_id", "label", "k", "v", "code", "error"] and books.shape == (4, 3, 4)
    coded, books = vector_codes.encode(spark, table(spark, []), "vec_id")
    assert coded.count() == 0 and books.shape == (8, 0, 0)
    with pytest.raises(ValueError, match="no 8 equal parts"):
        vector_codes.encode(spark, table(spark, [(1, [1.0] * 9, 0)]), "vec_id")


def test_nearest_wraps_around():
    """Norms beyond 64 bits cancel: the distance itself fits."""
    part = np.full((1, 8), (1 << 29) - 1, np.int64) * 4
    at, away = vector_codes.nearest(part, part[[0, 0]] - np.array([[3], [3]]))
    assert at[0] == 0 and away[0] == 72


def test_scaled_is_bounded():
    with pytest.raises(ValueError, match="beyond"):
        vectors.scaled(np.array([[1e9]]), 4096, 1 << 29)


# ---- nearest neighbours


def plain_neighbours(rows, asked, nearest=10):
    rows = {(r[0], tuple(np.float32(c) for c in r[1])) for r in kept(rows) if r[0] is not None and any(r[1])}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = []
    for i, v in rows:
        if asked(i):
            score = np.sqrt(sum((x[:, j] - float(v[j])) ** 2 for j in range(x.shape[1])))
            order = [k for k in np.lexsort([ids, score]) if ids[k] != i][:nearest]
            out += [(i, rank, int(ids[k]), float(score[k])) for rank, k in enumerate(order, 1)]
    return sorted(out)


def test_neighbours_are_exact_on_few_lists(spark):
    rows = [*hard(), (400, [0.0] * 16, 1), *[(k, hard()[80 + k % 5][1], 1) for k in range(500, 540)]]
    df = table(spark, rows)
    got = neighbours.nearest_neighbours(spark, df, "vec_id", df.filter("vec_id % 10 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == plain_neighbours(rows, lambda i: i % 10 == 0)


def test_neighbours_small(spark):
    find = lambda rows: neighbours.nearest_neighbours(spark, table(spark, rows), "vec_id", table(spark, rows)).collect()
    assert find([]) == [] and find([(1, [1.0, 0.0], 0)]) == [] and find([(1, None, 0), (None, [1.0], 0)]) == []
    assert [tuple(r) for r in find([(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0)])] == [(1, 1, 2, 0.0), (2, 1, 1, 0.0)]
    assert sorted(tuple(r)[:3] for r in find([(1, [2.0], 0), (2, [1.0], 0), (3, [3.0], 0)])) == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)]


@pytest.mark.parametrize("kind", ["even", "clusters"])
def test_neighbours_recall(spark, monkeypatch, kind):
    """Many lists, small blocks: recall against brute force, exact scores, and boundary vectors in several lists."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 40)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 24)) if kind == "even" else rng.standard_normal((3000, 24)) * 0.3 + rng.standard_normal((30, 24))[rng.integers(0, 30, 3000)]
    rows = [(k, v, 0) for k, v in enumerate(x.astype(np.float32).tolist())]
    df = table(spark, rows)
    got = neighbours.nearest_neighbours(spark, df, "vec_id", df.filter("vec_id % 50 = 0")).collect()
    want = plain_neighbours(rows, lambda i: i % 50 == 0)
    assert len(got) == len(want)
    pairs = {(q, i): s for q, _, i, s in want}
    found = [tuple(r) for r in got if (r[0], r[2]) in pairs]
    assert len(found) >= 0.9 * len(want) and all(pairs[q, i] == s for q, _, i, s in found)
    index = neighbours.build(spark, df, "vec_id")
    homes = index.postings.groupBy("pid").count().toPandas()["count"]
    assert len(homes) == 3000 and homes.max() <= neighbours.REPLICAS and (homes > 1).any()
    searched = np.bincount(index.centroids.wanted(x[:500].astype(np.float32).astype(np.float64))[0])
    assert searched.mean() < (75 if kind == "even" else 35) and searched.min() >= neighbours.LEAST_LISTS


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((2000, 12))
    graph = neighbours.Centroids.linked(points, rng)
    x = rng.standard_normal((300, 12))
    away = graph.search(x, 8, 1.1)
    true = neighbours.squared(x, points)
    assert np.isinf(away).mean() > 0.4  # most centroids are never looked at
    assert (away.min(1) <= true.min(1) + 1e-9).mean() > 0.97


def test_balanced_groups():
    rng = np.random.default_rng(5)
    assert neighbours.balanced(rng.standard_normal((100, 3)), 7, rng).shape == (7, 3)
    assert neighbours.balanced(np.zeros((10, 3)), 10, rng).shape == (10, 3)
