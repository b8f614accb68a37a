"""Geographic column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwright.schemas import EARTH_RADIUS_KM


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in kilometres between two points given in degrees."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_dlat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), F.lit(2)
    )
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2) * F.atan2(F.sqrt(h), F.sqrt(1 - h)))


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column, raw: bool = False) -> Column:
    """Direction from the first to the second point as whole degrees in 0..360.

    ``raw=True`` feeds the degrees to the trigonometric functions unconverted, which is
    what older results were computed with.
    """
    angle = (lambda c: c) if raw else F.radians
    dlon = angle(lon2 - lon1)
    phi1, phi2 = angle(lat1), angle(lat2)
    y = F.sin(dlon) * F.cos(phi2)
    x = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(dlon)
    degrees = F.atan2(y, x) * 180 / F.pi()
    whole = degrees.cast("int")
    return F.when(degrees < 0, whole + 360).otherwise(whole)
