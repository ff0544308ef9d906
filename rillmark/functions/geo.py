"""Column expressions: distances, headings, the four fixed projections, chart scales."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius, sphere of Web Mercator, ellipsoid GRS80, UTM zone 10 north.
MEAN_RADIUS = 6371008.8
MERCATOR_RADIUS = 6378137.0
FLATTENING = 1 / 298.257222101
MERIDIAN, SCALE, FALSE_EAST = -123.0, 0.9996, 500000.0

_n = FLATTENING / (2 - FLATTENING)
RECTIFYING = MERCATOR_RADIUS / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
ECC = 2 * math.sqrt(_n) / (1 + _n)
#: Series in the third flattening: forward and inverse to the fourth order, conformal to geodetic latitude to the fifth.
ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
    13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
    61 * _n**3 / 240 - 103 * _n**4 / 140,
    49561 * _n**4 / 161280,
)
BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360,
    _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440,
    17 * _n**3 / 480 - 37 * _n**4 / 840,
    4397 * _n**4 / 161280,
)
DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45 + 26 * _n**5 / 45,
    7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45 + 2704 * _n**5 / 315,
    56 * _n**3 / 15 - 136 * _n**4 / 35 - 1262 * _n**5 / 105,
    4279 * _n**4 / 630 - 332 * _n**5 / 35,
    4174 * _n**5 / 315,
)


def planar(dx: Column, dy: Column) -> Column:
    """Length of a planar step; not hypot, whose last bit differs between engines."""
    return F.sqrt(dx * dx + dy * dy)


def ground_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Equirectangular distance in metres, at the mean latitude."""
    x = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return planar(x, F.radians(lat2 - lat1)) * MEAN_RADIUS


def turn(angle: Column) -> Column:
    """Radians clockwise from north as degrees in 0..360."""
    return F.pmod(F.degrees(angle) + 360, F.lit(360.0))


def heading(de: Column, dn: Column) -> Column:
    return turn(F.atan2(de, dn))


def chord_bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    return heading((lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2)), lat2 - lat1)


def great_circle_bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return turn(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))


def to_utm(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in UTM 10N."""
    s, l = F.sin(F.radians(lat)), F.radians(lon - MERIDIAN)
    t = F.sinh(F.atanh(s) - F.atanh(s * ECC) * ECC)
    xi, eta = F.atan2(t, F.cos(l)), F.atanh(F.sin(l) / F.sqrt(t * t + 1))
    east, north = eta, xi
    for j, a in enumerate(ALPHA, 1):
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    return east * (SCALE * RECTIFYING) + FALSE_EAST, north * (SCALE * RECTIFYING)


def from_utm(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude."""
    x, e = north / (SCALE * RECTIFYING), (east - FALSE_EAST) / (SCALE * RECTIFYING)
    xi, eta = x, e
    for j, b in enumerate(BETA, 1):
        xi = xi - F.sin(x * (2 * j)) * F.cosh(e * (2 * j)) * b
        eta = eta - F.cos(x * (2 * j)) * F.sinh(e * (2 * j)) * b
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + F.sin(chi * (2 * j)) * d
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + MERIDIAN, F.degrees(lat)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * MERCATOR_RADIUS, F.ln(F.tan(F.radians(lat) / 2 + math.pi / 4)) * MERCATOR_RADIUS


def from_mercator(mx: Column, my: Column) -> tuple[Column, Column]:
    return F.degrees(mx / MERCATOR_RADIUS), F.degrees(F.atan(F.exp(my / MERCATOR_RADIUS)) * 2 - math.pi / 2)


def utm_to_mercator(east: Column, north: Column) -> tuple[Column, Column]:
    return to_mercator(*from_utm(east, north))


def spacing_label(spacing: Column) -> Column:
    """10 -> 10m, 0.5 -> 0p5m."""
    return F.concat(F.replace(F.regexp_replace(spacing.cast("string"), r"\.0$", ""), F.lit("."), F.lit("p")), F.lit("m"))


def first_step(ladder: tuple[float, ...], fits) -> Column:
    """The first step of the ladder that fits, else the last."""
    return F.coalesce(F.get(F.filter(F.array(*map(F.lit, ladder)), fits), F.lit(0)), F.lit(ladder[-1]))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
