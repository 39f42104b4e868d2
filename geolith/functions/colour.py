"""Colour conversion and statistics transfer as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: sRGB primaries to CIE XYZ and the D65 white point.
TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
WHITE = (0.95047, 1.0, 1.08883)


def lab(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """CIELAB of sRGB values from 0 to 1."""
    linear = [F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4))) for c in (r, g, b)]
    f = []
    for row, white in zip(TO_XYZ, WHITE, strict=True):
        t = (linear[0] * row[0] + linear[1] * row[1] + linear[2] * row[2]) / white
        f.append(F.when(t > 216 / 24389, F.cbrt(t)).otherwise((t * (24389 / 27) + 16.0) / 116.0))
    return f[1] * 116.0 - 16.0, (f[0] - f[1]) * 500.0, (f[1] - f[2]) * 200.0


def moved(x: Column, mean: Column, spread: Column, to_mean: Column, to_spread: Column) -> Column:
    """x with the mean and spread of another population."""
    return F.try_divide(x - mean, F.nullif(spread, F.lit(0.0))) * to_spread + to_mean


def _root(a: Column, b: Column, d: Column) -> tuple[Column, Column, Column]:
    """Root of the symmetric positive matrix (a, b; b, d)."""
    det = F.sqrt(a * d - b * b)
    tau = F.sqrt(a + d + det * 2)
    return (a + det) / tau, b / tau, (d + det) / tau


def _around(m: tuple[Column, Column, Column], s: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """m s m, of symmetric matrices."""
    (a, b, d), (p, q, r) = m, s
    return a * (a * p + b * q) + b * (a * q + b * r), a * (b * p + d * q) + b * (b * q + d * r), b * (b * p + d * q) + d * (b * q + d * r)


def transport(a: Column, b: Column, d: Column, ta: Column, tb: Column, td: Column) -> tuple[Column, Column, Column]:
    """The symmetric matrix that takes the covariance (a, b; b, d) to (ta, tb; tb, td) and moves least."""
    h = _root(a, b, d)
    det = h[0] * h[2] - h[1] * h[1]
    return _around((h[2] / det, -h[1] / det, h[0] / det), _root(*_around(h, (ta, tb, td))))


def roof_score(r: Column, g: Column, b: Column) -> Column:
    """How much a colour looks like a roof: bright and not green."""
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return unit(unit((r + g + b) / 3.0) * unit(F.lit(0.15) - (g - (r + b) / 2.0)) * 6.0)


def blend(base: Column, over: Column, alpha: Column) -> Column:
    return over * alpha + base * (F.lit(1.0) - alpha)


def clamped_shift(value: Column, mean: Column, spread: Column, to_mean: Column, to_spread: Column, most: float) -> Column:
    """How far a channel moves towards another's mean and spread, at most `most`; a spread below 0.001 counts as 1."""
    target = (value - mean) / F.when(spread < 1e-3, 1.0).otherwise(spread) * to_spread + to_mean
    return F.least(F.greatest(target - value, F.lit(-most)), F.lit(most))
