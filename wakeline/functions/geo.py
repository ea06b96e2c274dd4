"""Great-circle distance (haversine, atan2 form) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def haversine_a(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """The haversine term ``a`` in [0, 1] (may exceed 1 by rounding near antipodes)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    return F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)


def distance_from_a(a: Column, radius: float) -> Column:
    return F.lit(radius) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def distance_nm(lat1, lon1, lat2, lon2, radius: float = 3440.065) -> Column:
    """Great-circle distance in the unit of ``radius`` (nautical miles by default)."""
    def as_col(x):
        if isinstance(x, Column):
            return x
        return F.col(x) if isinstance(x, str) else F.lit(float(x))

    lat1, lon1, lat2, lon2 = (as_col(x) for x in (lat1, lon1, lat2, lon2))
    return distance_from_a(haversine_a(lat1, lon1, lat2, lon2), radius)
