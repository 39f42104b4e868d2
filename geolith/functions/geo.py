"""Grids, map projections and angles as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """Square cells counted west and north from the grid's south-east corner."""

    east: float
    south: float
    cell: float
    columns: int
    rows: int

    def cell_of(self, e: Column, n: Column) -> tuple[Column, Column]:
        """Column and row of the cell; null outside. Floors before the range check, so no fraction slips in."""
        c, r = F.floor((F.lit(self.east) - e) / self.cell), F.floor((n - F.lit(self.south)) / self.cell)
        inside = c.between(0, self.columns - 1) & r.between(0, self.rows - 1)
        return F.when(inside, c), F.when(inside, r)

    def bounds_of(self, c: Column, r: Column) -> dict[str, Column]:
        return {
            "e_min": F.lit(self.east) - (c + 1) * self.cell, "e_max": F.lit(self.east) - c * self.cell,
            "n_min": F.lit(self.south) + r * self.cell, "n_max": F.lit(self.south) + (r + 1) * self.cell,
        }


#: Semi-major axis and flattening of WGS 84; scale and false easting of a UTM zone.
AXIS, FLATTENING, SCALE, FALSE_EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0


def third_flattening(axis: float = AXIS, flattening: float = FLATTENING) -> tuple[float, float, list[float]]:
    """Rectifying radius, eccentricity and the sixth-order Krueger coefficients of the forward series."""
    n = flattening / (2 - flattening)
    radius = axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    ]
    return radius, (2 * n**0.5) / (1 + n), alpha


@dataclass(frozen=True)
class TransverseMercator:
    """A projection: central meridian in degrees, scale there, false easting, and the ellipsoid."""

    meridian: float
    scale: float = SCALE
    east: float = FALSE_EAST
    axis: float = AXIS
    flattening: float = FLATTENING

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Easting and northing on the northern hemisphere."""
        radius, ecc, alpha = third_flattening(self.axis, self.flattening)
        phi, lam = F.radians(lat), F.radians(lon - F.lit(self.meridian))
        sine = F.sin(phi)
        t = F.sinh(F.atanh(sine) - F.lit(ecc) * F.atanh(F.lit(ecc) * sine))
        xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
        north, east = xi, eta
        for j, a in enumerate(alpha, 1):
            north = north + F.lit(a) * F.sin(xi * (2.0 * j)) * F.cosh(eta * (2.0 * j))
            east = east + F.lit(a) * F.cos(xi * (2.0 * j)) * F.sinh(eta * (2.0 * j))
        return F.lit(self.east) + F.lit(self.scale * radius) * east, F.lit(self.scale * radius) * north

    def inverse(self, e: Column, n: Column) -> tuple[Column, Column]:
        """Longitude and latitude on the northern hemisphere."""
        radius, ecc, _ = third_flattening(self.axis, self.flattening)
        x, y = n / F.lit(self.scale * radius), (e - self.east) / F.lit(self.scale * radius)
        xi, eta = x, y
        for j, b in enumerate(inverse_series(self.flattening), 1):
            xi = xi - F.lit(b) * F.sin(x * (2.0 * j)) * F.cosh(y * (2.0 * j))
            eta = eta - F.lit(b) * F.cos(x * (2.0 * j)) * F.sinh(y * (2.0 * j))
        t = F.sin(xi) / F.sqrt(F.sinh(eta) * F.sinh(eta) + F.cos(xi) * F.cos(xi))
        conformal = F.asinh(t)
        q = conformal
        for _ in range(5):
            q = conformal + F.lit(ecc) * F.atanh(F.lit(ecc) * F.tanh(q))
        return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + F.lit(self.meridian), F.degrees(F.atan(F.sinh(q)))


def utm_forward(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing on the northern hemisphere."""
    return TransverseMercator(6.0 * zone - 183.0).forward(lon, lat)


def inverse_series(flattening: float = FLATTENING) -> list[float]:
    """Fixed values of the inverse transverse Mercator series, to the sixth order of the third flattening."""
    n = flattening / (2 - flattening)
    return [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360 - 81 * n**5 / 512 + 96199 * n**6 / 604800,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440 + 46 * n**5 / 105 - 1118711 * n**6 / 3870720,
        17 * n**3 / 480 - 37 * n**4 / 840 - 209 * n**5 / 4480 + 5569 * n**6 / 90720,
        4397 * n**4 / 161280 - 11 * n**5 / 504 - 830251 * n**6 / 7257600,
        4583 * n**5 / 161280 - 108847 * n**6 / 3991680,
        20648693 * n**6 / 638668800,
    ]


def utm_inverse(e: Column, n: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude of UTM coordinates on the northern hemisphere."""
    return TransverseMercator(6.0 * zone - 183.0).inverse(e, n)


def slippy_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web map tile that holds a point."""
    n = float(1 << zoom)
    phi = F.radians(lat)
    return ((lon + 180.0) / 360.0 * n).cast("int"), ((1.0 - F.asinh(F.tan(phi)) / F.lit(3.141592653589793)) / 2.0 * n).cast("int")


def axis_difference(a: Column, b: Column) -> Column:
    """Signed difference of two axes in degrees, from -90 to 90."""
    return F.pmod(b - a + 90.0, F.lit(180.0)) - 90.0


def azimuth(east: Column, north: Column) -> Column:
    """Degrees clockwise from north."""
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def rotate(x: Column, y: Column, heading: Column) -> tuple[Column, Column]:
    """A local point turned clockwise by a heading in degrees."""
    a = F.radians(heading)
    return x * F.cos(a) + y * F.sin(a), y * F.cos(a) - x * F.sin(a)


def ramp(value: Column, low: float, high: float) -> Column:
    """0 at low, 1 at high, straight between, clipped."""
    return F.least(F.greatest((value - low) / (high - low), F.lit(0.0)), F.lit(1.0))


def smoothstep(value: Column, low: float, high: float) -> Column:
    t = ramp(value, low, high)
    return t * t * (F.lit(3.0) - t * 2.0)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * AXIS, F.asinh(F.tan(F.radians(lat))) * AXIS


def web_mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / AXIS), F.degrees(F.atan(F.sinh(y / AXIS)))


#: Fixed values of EPSG 3035: GRS 80, centre, false easting and northing.
GRS80_FLATTENING, LAEA_LON, LAEA_LAT, LAEA_EAST, LAEA_NORTH = 1 / 298.257222101, 10.0, 52.0, 4321000.0, 3210000.0


@dataclass(frozen=True)
class LaeaTerms:
    """What the equal-area projection's formulas need of the ellipsoid and the centre."""

    ecc: float
    q_pole: float
    radius: float
    sin_centre: float
    cos_centre: float
    stretch: float


def laea_terms() -> LaeaTerms:
    square = GRS80_FLATTENING * (2 - GRS80_FLATTENING)
    ecc, sine = math.sqrt(square), math.sin(math.radians(LAEA_LAT))
    q = lambda s: (1 - square) * (s / (1 - square * s * s) + math.atanh(ecc * s) / ecc)
    radius, sin_centre = AXIS * math.sqrt(q(1.0) / 2), q(sine) / q(1.0)
    cos_centre = math.sqrt(1 - sin_centre**2)
    return LaeaTerms(ecc, q(1.0), radius, sin_centre, cos_centre, AXIS * math.cos(math.radians(LAEA_LAT)) / math.sqrt(1 - square * sine * sine) / (radius * cos_centre))


def laea_forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in EPSG 3035."""
    t = laea_terms()
    s, lam = F.sin(F.radians(lat)), F.radians(lon - LAEA_LON)
    sine = (s / (1 - F.lit(t.ecc**2) * s * s) + F.atanh(F.lit(t.ecc) * s) / t.ecc) * ((1 - t.ecc**2) / t.q_pole)
    cosine = F.sqrt(1 - sine * sine)
    b = F.lit(t.radius) * F.sqrt(F.lit(2.0) / (1 + F.lit(t.sin_centre) * sine + F.lit(t.cos_centre) * cosine * F.cos(lam)))
    return F.lit(LAEA_EAST) + b * t.stretch * cosine * F.sin(lam), F.lit(LAEA_NORTH) + b / t.stretch * (F.lit(t.cos_centre) * sine - F.lit(t.sin_centre) * cosine * F.cos(lam))


def laea_inverse(e: Column, n: Column) -> tuple[Column, Column]:
    """Longitude and latitude of EPSG 3035 coordinates."""
    t = laea_terms()
    x, y = (e - LAEA_EAST) / t.stretch, (n - LAEA_NORTH) * t.stretch
    rho = F.hypot(x, y)
    c = F.asin(rho / (2 * t.radius)) * 2
    authalic = F.when(rho == 0, F.asin(F.lit(t.sin_centre))).otherwise(F.asin(F.cos(c) * t.sin_centre + y * F.sin(c) * t.cos_centre / rho))
    lam = F.atan2(x * F.sin(c), rho * t.cos_centre * F.cos(c) - y * t.sin_centre * F.sin(c))
    e2, e4, e6 = t.ecc**2, t.ecc**4, t.ecc**6
    phi = authalic + F.sin(authalic * 2) * (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) + F.sin(authalic * 4) * (23 * e4 / 360 + 251 * e6 / 3780) + F.sin(authalic * 6) * (761 * e6 / 45360)
    return F.degrees(lam) + LAEA_LON, F.degrees(phi)


def orientation(heading: Column) -> Column:
    """A heading in degrees as radians from 0 to below a whole turn."""
    return F.pmod(F.radians(heading), F.lit(2 * math.pi))


def nearer_direction(heading: Column, axis: Column) -> Column:
    """The direction of an axis, in degrees, that lies nearer to a heading."""
    apart = F.abs(F.pmod(axis - heading + 180.0, F.lit(360.0)) - 180.0)
    return F.pmod(F.when(apart < 90, axis).otherwise(axis + 180.0), F.lit(360.0))
