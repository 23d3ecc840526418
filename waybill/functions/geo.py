"""Distances and centroids on latitude / longitude in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.params import Box

# Fixed value: mean earth radius in km.
EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in km; NULL when any coordinate is NULL."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    chord = (
        half_lat * half_lat
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    )
    # Rounding can push antipodal points past 1, where asin is NaN. `least` would turn an
    # unknown distance into half the globe, as it skips NULL.
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))


def centroids(points: DataFrame, key: str, lat: str, lng: str, box: Box) -> DataFrame:
    """Mean point per key over the points inside `box` (edges included)."""
    inside = F.col(lat).between(box.south, box.north) & F.col(lng).between(box.west, box.east)
    return (
        points.filter(inside)
        .groupBy(key)
        .agg(F.avg(lat).alias("lat"), F.avg(lng).alias("lng"))
    )
