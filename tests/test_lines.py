"""Edges, lines and shifts on planted figures."""

import math

import numpy as np
import pytest

from geolith.operators import edges as E


def raster(spark, z):
    return spark.createDataFrame([(i, j, float(z[i, j])) for i in range(z.shape[0]) for j in range(z.shape[1])], "i INT, j INT, z DOUBLE").repartition(3)


def cells(d):
    return {(r["i"], r["j"]) for r in d.collect()}


def test_edges_of_a_square(spark):
    """One cell wide around a bright square; a faint one beside it has none, but one that touches strong edges stays."""
    z = np.zeros((30, 30))
    z[8:20, 6:18] = 100
    z[3:6, 22:27] = 5
    got = cells(E.edges(raster(spark, z), 30.0, 200.0, 30))
    assert got and all(5 <= i <= 21 and 3 <= j <= 20 for i, j in got)
    for i in range(11, 17):
        assert len([j for a, j in got if a == i]) == 2
    assert not any(10 < i < 17 and 8 < j < 15 for i, j in got)
    assert cells(E.edges(raster(spark, np.zeros((5, 5))), 1.0, 2.0, 5)) == set()
    z[25, :] = np.linspace(0, 40, 30)  # a weak line far from strong ones
    assert cells(E.edges(raster(spark, z), 30.0, 200.0, 30)) == got


def test_votes_find_lines_and_their_segments(spark):
    on = {(10, j) for j in range(5, 35)} | {(10, j) for j in range(60, 80)} | {(i, i) for i in range(20, 45)}
    d = spark.createDataFrame(sorted(on), "i INT, j INT")
    total = E.votes(d, 180).groupBy("k").sum("votes").collect()
    assert len(total) == 180 and {r[1] for r in total} == {len(on)}
    found = {(r["k"], r["rho"]): r["votes"] for r in E.lines(d, 180, 24).collect()}
    assert found[90, 10] == 50 and max(v for (k, rho), v in found.items() if abs(k - 135) < 3 and abs(rho) < 3) >= 25
    runs = sorted((r["start"], r["stop"], r["cells"]) for r in E.segments(d, E.lines(d, 180, 40), 180, 5.0, 10.0).filter("k = 90").collect())
    assert [(abs(b - a), n) for a, b, n in runs] == [(pytest.approx(19), 20), (pytest.approx(29), 30)]


@pytest.mark.parametrize(("height", "width", "shift", "block"), [(64, 90, (5, -11), 16), (33, 47, (-8, 6), 7), (50, 20, (0, 0), 64), (21, 130, (9, 60), 16)])
def test_phase_shift_finds_planted_shifts(spark, height, width, shift, block):
    rng = np.random.default_rng(height)
    big = rng.random((height, width)).cumsum(0).cumsum(1) % 7
    moved = np.roll(big, (-shift[0], -shift[1]), (0, 1)) + rng.random((height, width)) * 0.5
    got = E.phase_shift(raster(spark, big), raster(spark, moved), height, width, block, window=False).collect()
    assert [(r["di"], r["dj"]) for r in got] == [shift] and got[0]["response"] > 0.3


def test_phase_shift_of_cut_rasters_and_of_none(spark):
    rng = np.random.default_rng(4)
    big = rng.random((90, 90))
    a, b = big[10:70, 12:80], big[13:73, 8:76]  # the same ground: b is a, moved by (3, -4)
    got = E.phase_shift(raster(spark, a), raster(spark, b), 60, 68).collect()
    assert [(r["di"], r["dj"]) for r in got] == [(3, -4)]
    none = spark.createDataFrame([], "i INT, j INT, z DOUBLE")
    assert E.phase_shift(none, none, 8, 8).count() == 0


def test_sectors_go_along_the_gradient(spark):
    rows = spark.createDataFrame([(float(math.cos(math.radians(a))), float(math.sin(math.radians(a)))) for a in (0, 45, 90, 135, 180, 225, 270, 315)], "gx DOUBLE, gy DOUBLE")
    assert [r[0] for r in rows.select(E.sector(rows["gx"], rows["gy"])).collect()] == [0, 1, 2, 3, 0, 1, 2, 3]
