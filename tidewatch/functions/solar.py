"""Position of the sun as column arithmetic, by the low-order Fourier series of declination and equation of time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of the series: constant, cos, sin, cos 2, sin 2, cos 3, sin 3 of the year's angle.
EQUATION_OF_TIME = (0.000075, 0.001868, -0.032077, -0.014615, -0.040849)
DECLINATION = (0.006918, -0.399912, 0.070257, -0.006758, 0.000907, -0.002697, 0.00148)


def _series(g: Column, terms: tuple[float, ...]) -> Column:
    out = F.lit(terms[0])
    for k, a in enumerate(terms[1:]):
        out = out + a * (F.cos, F.sin)[k % 2]((k // 2 + 1) * g)
    return out


def position(ts: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """Elevation and azimuth (from north) in degrees at a UTC instant."""
    g = 2 * F.pi() / 365 * (F.dayofyear(ts) - 1 + (F.hour(ts) - 12) / 24.0)
    dec, phi = _series(g, DECLINATION), F.radians(lat)
    minute = F.hour(ts) * 60.0 + F.minute(ts) + 229.18 * _series(g, EQUATION_OF_TIME) + 4 * lon
    angle = F.radians(minute / 4 - 180)
    up = F.asin(F.sin(phi) * F.sin(dec) + F.cos(phi) * F.cos(dec) * F.cos(angle))
    return F.degrees(up), F.degrees(F.atan2(F.sin(angle), F.cos(angle) * F.sin(phi) - F.tan(dec) * F.cos(phi))) + 180
