"""Distances and bearings on the sphere, in degrees and kilometres."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; 0 for equal points, never NaN."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from the first point to the second, in [0, 360)."""
    a, b, turn = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    y = F.sin(turn) * F.cos(b)
    x = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))
