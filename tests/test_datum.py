"""Datum shifts against plain Python and there and back."""

import math

import pytest
from pyspark.sql import functions as F

from geolith.functions import datum

PLACES = [(20.5, 41.0), (21.0, 42.0), (22.9, 42.35), (21.43, 41.9961), (23.0, 40.85)]


def test_there_and_back_within_a_millimetre(spark):
    d = spark.createDataFrame(PLACES, "lon DOUBLE, lat DOUBLE")
    with_heights = datum.balkans_7(datum.to_balkans_7(d.withColumn("h", F.lit(350.0)), "lon", "lat", "e", "n", "h"), "e", "n", "lon2", "lat2", "h")
    assert all(abs(r["h"] - 350) < 1e-6 for r in with_heights.collect())
    for back, most in ((with_heights, 1e-6), (datum.balkans_7(datum.to_balkans_7(d, "lon", "lat", "e", "n"), "e", "n", "lon2", "lat2"), 5e-3)):
        for r in back.collect():
            assert abs(r["lon2"] - r["lon"]) * 111_000 < most and abs(r["lat2"] - r["lat"]) * 111_000 < most
            assert 7_440_000 < r["e"] < 7_680_000 and 4_500_000 < r["n"] < 4_720_000


def test_seven_parameters(spark):
    shift = datum.Shift(574.7, 132.5, -464.3, 5.1, -1.6, -7.4, 2.6)
    product = [[sum(a * b for a, b in zip(row, col)) for col in zip(*shift.inverse_matrix())] for row in shift.matrix()]
    assert all(product[i][j] == pytest.approx(float(i == j), abs=1e-12) for i in range(3) for j in range(3))
    d = spark.createDataFrame(PLACES, "lon DOUBLE, lat DOUBLE").withColumns({"a": F.col("lon"), "b": F.col("lat"), "h": F.lit(0.0)})
    there = datum.to_wgs84(d, "a", "b", "h", shift, datum.BESSEL_AXIS, datum.BESSEL_FLATTENING)
    back = datum.from_wgs84(there.withColumns({"c": F.col("a"), "d": F.col("b")}), "c", "d", "h", shift, datum.BESSEL_AXIS, datum.BESSEL_FLATTENING)
    for r in back.collect():
        assert math.hypot(r["a"] - r["lon"], r["b"] - r["lat"]) > 1e-4  # it does move
        assert abs(r["c"] - r["lon"]) * 111_000 < 1e-6 and abs(r["d"] - r["lat"]) * 111_000 < 1e-6 and abs(r["h"]) < 1e-6
