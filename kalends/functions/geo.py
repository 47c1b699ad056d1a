"""Distances and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6_371_000


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p, q = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((q - p) / 2), F.lit(2)) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * RADIUS_M * F.asin(F.sqrt(a))


def inside(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])
