"""Geodesic expressions on a sphere of radius 6 371 000 m."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; the root is clamped so rounding never gives NaN."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in [0, 360)."""
    dlon = F.radians(lon2 - lon1)
    east = F.sin(dlon) * F.cos(F.radians(lat2))
    north = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def interpolate(start: Column, end: Column, frac: Column) -> Column:
    """Linear position between two coordinates."""
    return start + (end - start) * frac
