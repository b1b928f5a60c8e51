"""Spherical and physical formulas as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000
REFRACTION = 1.13


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two places given in degrees."""
    a, b = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon1 - lon2))
    return EARTH_RADIUS_M * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    a, b = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)


def horizon(height: Column) -> Column:
    """Metres to the horizon from a height, with refraction."""
    return F.sqrt(2 * EARTH_RADIUS_M * F.lit(REFRACTION) * height)


def tile_latitude(row: Column, zoom: int) -> Column:
    """Latitude of the top of a web-map tile row."""
    return F.degrees(F.atan(F.sinh(F.lit(3.141592653589793) * (1 - 2 * row / (1 << zoom)))))


def degrees_of(text: Column) -> Column:
    """Signed degrees of ``50-12-30N`` or ``50 12 30 W``; null where it can't be read."""
    part = lambda i: F.regexp_extract(text, r"^\s*(\d+)\D+(\d+)\D+(\d+(?:\.\d+)?)\D*([NSEWnsew])\s*$", i)
    sign = F.when(F.upper(part(4)).isin("S", "W"), -1.0).otherwise(1.0)
    value = part(1).try_cast("double") + part(2).try_cast("double") / 60 + part(3).try_cast("double") / 3600
    return F.when(part(4) != "", sign * value)
