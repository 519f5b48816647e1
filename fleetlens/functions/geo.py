"""Distances between coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _half_chord(delta_degrees: Column) -> Column:
    return F.pow(F.sin(F.radians(delta_degrees) / 2.0), F.lit(2.0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the root is held at 1 so rounding near antipodes cannot give NaN."""
    chord = _half_chord(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * _half_chord(lon2 - lon1)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def squared_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared planar distance in degrees, enough to rank close points."""
    dlat, dlon = lat2 - lat1, lon2 - lon1
    return dlat * dlat + dlon * dlon
