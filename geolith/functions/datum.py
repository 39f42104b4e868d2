"""Datum shifts: from degrees on one ellipsoid to degrees on another through geocentric coordinates.

Each step is a column of its own: as one nested expression, its size would grow with the power of the steps.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolith.functions.geo import AXIS, FLATTENING, TransverseMercator


@dataclass(frozen=True)
class Shift:
    """Seven parameters from a datum to WGS 84, in the position vector convention: metres, seconds of arc, parts in a million.

    As a matrix: X' = T + (1 + s) R X; the way back takes the inverse matrix, not changed signs.
    """

    x: float
    y: float
    z: float
    turn_x: float = 0.0
    turn_y: float = 0.0
    turn_z: float = 0.0
    scale: float = 0.0

    def matrix(self) -> list[list[float]]:
        a, b, c = (math.radians(t / 3600) for t in (self.turn_x, self.turn_y, self.turn_z))
        s = 1 + self.scale * 1e-6
        return [[s, -s * c, s * b], [s * c, s, -s * a], [-s * b, s * a, s]]

    def inverse_matrix(self) -> list[list[float]]:
        (a, b, c), (d, e, f), (g, h, i) = self.matrix()
        det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
        return [[(e * i - f * h) / det, (c * h - b * i) / det, (b * f - c * e) / det], [(f * g - d * i) / det, (a * i - c * g) / det, (c * d - a * f) / det], [(d * h - e * g) / det, (b * g - a * h) / det, (a * e - b * d) / det]]


# Fixed values of EPSG:6316, the Balkans zone around 21 degrees: Bessel's ellipsoid, projection and shift.
BESSEL_AXIS, BESSEL_FLATTENING = 6377397.155, 1 / 299.1528128
BALKANS_7 = TransverseMercator(21.0, 0.9999, 7_500_000.0, BESSEL_AXIS, BESSEL_FLATTENING)
BALKANS_SHIFT = Shift(682.0, -203.0, 480.0)


def geocentric(lon: Column, lat: Column, height: Column, axis: float = AXIS, flattening: float = FLATTENING) -> tuple[Column, Column, Column]:
    e2 = flattening * (2 - flattening)
    phi, lam = F.radians(lat), F.radians(lon)
    n = F.lit(axis) / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    return (n + height) * F.cos(phi) * F.cos(lam), (n + height) * F.cos(phi) * F.sin(lam), (n * (1 - e2) + height) * F.sin(phi)


def geodetic(rows: DataFrame, x: str, y: str, z: str, lon: str, lat: str, height: str, axis: float = AXIS, flattening: float = FLATTENING) -> DataFrame:
    """Adds longitude, latitude and height of geocentric columns, by two rounds from the parametric latitude: far below a millimetre near the ground."""
    e2 = flattening * (2 - flattening)
    b = axis * (1 - flattening)
    rows = rows.withColumn("_p", F.hypot(x, y)).withColumn("_beta", F.atan2(F.col(z) * axis, F.col("_p") * b))
    for _ in range(2):
        rows = rows.withColumn("_phi", F.atan2(F.col(z) + F.lit(e2 / (1 - e2) * b) * F.pow(F.sin("_beta"), 3), F.col("_p") - F.lit(e2 * axis) * F.pow(F.cos("_beta"), 3)))
        rows = rows.withColumn("_beta", F.atan2((1 - flattening) * F.sin("_phi"), F.cos("_phi")))
    normal = F.lit(axis) / F.sqrt(1 - e2 * F.sin("_phi") * F.sin("_phi"))
    above = F.col("_p") * F.cos("_phi") + F.col(z) * F.sin("_phi") - F.lit(axis * axis) / normal
    return rows.withColumns({lon: F.degrees(F.atan2(y, x)), lat: F.degrees("_phi"), height: above}).drop("_p", "_beta", "_phi")


def _times(m: list[list[float]], v: tuple[Column, ...]) -> tuple[Column, ...]:
    return tuple(sum((F.lit(a) * c for a, c in zip(row[1:], v[1:], strict=True)), F.lit(row[0]) * v[0]) for row in m)


_XYZ = ("_x", "_y", "_z")


def to_wgs84(rows: DataFrame, lon: str, lat: str, height: str, shift: Shift, axis: float, flattening: float) -> DataFrame:
    """Longitude, latitude and height above the ellipsoid, on another datum, become those on WGS 84."""
    there = rows.withColumns(dict(zip(_XYZ, geocentric(F.col(lon), F.col(lat), F.col(height), axis, flattening), strict=True)))
    moved = _times(shift.matrix(), tuple(F.col(k) for k in _XYZ))
    there = there.withColumns({k: m + F.lit(t) for k, m, t in zip(_XYZ, moved, (shift.x, shift.y, shift.z), strict=True)})
    return geodetic(there, *_XYZ, lon, lat, height).drop(*_XYZ)


def from_wgs84(rows: DataFrame, lon: str, lat: str, height: str, shift: Shift, axis: float, flattening: float) -> DataFrame:
    """The way back, by the inverse matrix."""
    there = rows.withColumns({k: c - F.lit(t) for k, c, t in zip(_XYZ, geocentric(F.col(lon), F.col(lat), F.col(height)), (shift.x, shift.y, shift.z), strict=True)})
    there = there.withColumns(dict(zip(_XYZ, _times(shift.inverse_matrix(), tuple(F.col(k) for k in _XYZ)), strict=True)))
    return geodetic(there, *_XYZ, lon, lat, height, axis, flattening).drop(*_XYZ)


def balkans_7(rows: DataFrame, e: str, n: str, lon: str, lat: str, height: str | None = None) -> DataFrame:
    """Adds longitude and latitude on WGS 84 of EPSG:6316 coordinates.

    A column of heights above the ellipsoid is shifted with them. Without one, places are taken to lie on it: as the ellipsoids are tens of metres apart and their normals differ, that moves them
    by a millimetre or two.
    """
    there = rows.withColumns(dict(zip((lon, lat), BALKANS_7.inverse(F.col(e), F.col(n)), strict=True)))
    found = to_wgs84(there if height else there.withColumn("_h", F.lit(0.0)), lon, lat, height or "_h", BALKANS_SHIFT, BESSEL_AXIS, BESSEL_FLATTENING)
    return found if height else found.drop("_h")


def to_balkans_7(rows: DataFrame, lon: str, lat: str, e: str, n: str, height: str | None = None) -> DataFrame:
    """Adds EPSG:6316 coordinates of places on WGS 84; heights as in balkans_7()."""
    there = rows.withColumns({"_lon": F.col(lon), "_lat": F.col(lat), **({} if height else {"_h": F.lit(0.0)})})
    there = from_wgs84(there, "_lon", "_lat", height or "_h", BALKANS_SHIFT, BESSEL_AXIS, BESSEL_FLATTENING)
    return there.withColumns(dict(zip((e, n), BALKANS_7.forward(F.col("_lon"), F.col("_lat")), strict=True))).drop("_lon", "_lat", *([] if height else ["_h"]))
