"""Geometry on the globe as column expressions; every one stays null where an input is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.config import EARTH_RADIUS_M


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.sin((F.radians(lat2) - F.radians(lat1)) / 2), F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0))))


def wrapped(degrees: Column) -> Column:
    """Into [-180, 180)."""
    return F.pmod(degrees + 180.0, F.lit(360.0)) - 180.0


def length(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y)


def east_m(lon: Column, lon0: Column, lat0: Column) -> Column:
    """Metres east of an origin, flat earth; longitudes unwrapped."""
    return EARTH_RADIUS_M * F.cos(F.radians(lat0)) * F.radians(lon - lon0)


def north_m(lat: Column, lat0: Column) -> Column:
    return EARTH_RADIUS_M * F.radians(lat - lat0)


def compass(east: Column, north: Column) -> Column:
    """Degrees from north over east."""
    return F.degrees(F.atan2(east, north))
