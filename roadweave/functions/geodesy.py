"""Transverse Mercator in both directions as column expressions, by the published series (Snyder 1987)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A, FLATTENING, K0 = 6378137.0, 1 / 298.257223563, 0.9996
E2 = FLATTENING * (2 - FLATTENING)
EP2 = E2 / (1 - E2)


def utm_zone(lon: Column) -> Column:
    return F.least(F.greatest(((lon + 180.0) / 6.0).cast("int") + 1, F.lit(1)), F.lit(60))


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)



def _meridian(zone: int | Column) -> Column:
    """A zone's central meridian in degrees."""
    return (zone if isinstance(zone, Column) else F.lit(zone)) * 6.0 - 183.0


def _false_northing(north: bool | Column) -> Column:
    return F.when(north, 0.0).otherwise(1e7) if isinstance(north, Column) else F.lit(0.0 if north else 1e7)


def to_utm(lon: Column, lat: Column, zone: int | Column, north: bool | Column = True) -> tuple[Column, Column]:
    """Easting and northing in metres; zone and hemisphere may differ by row."""
    phi = F.radians(lat)
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    n = A / F.sqrt(1.0 - E2 * sin * sin)
    t, c = tan * tan, EP2 * cos * cos
    a = cos * (F.radians(lon) - F.radians(_meridian(zone)))
    m0 = 1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256
    m2 = 3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024
    m4, m6 = 15 * E2**2 / 256 + 45 * E2**3 / 1024, 35 * E2**3 / 3072
    arc = A * (m0 * phi - m2 * F.sin(2 * phi) + m4 * F.sin(4 * phi) - m6 * F.sin(6 * phi))
    a2 = a * a
    east = K0 * n * a * (1.0 + a2 * ((1.0 - t + c) / 6.0 + a2 * (5.0 - 18.0 * t + t * t + 72.0 * c - 58.0 * EP2) / 120.0)) + 500000.0
    north_ = K0 * (arc + n * tan * a2 * (0.5 + a2 * ((5.0 - t + 9.0 * c + 4.0 * c * c) / 24.0 + a2 * (61.0 - 58.0 * t + t * t + 600.0 * c - 330.0 * EP2) / 720.0)))
    return east, north_ + _false_northing(north)


def from_utm(easting: Column, northing: Column, zone: int | Column, north: bool | Column = True) -> tuple[Column, Column]:
    """Longitude and latitude in degrees."""
    mu = (northing - _false_northing(north)) / K0 / (A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256))
    e = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
    waves = ((2, 3 * e / 2 - 27 * e**3 / 32), (4, 21 * e**2 / 16 - 55 * e**4 / 32), (6, 151 * e**3 / 96), (8, 1097 * e**4 / 512))
    foot = mu
    for k, w in waves:
        foot = foot + w * F.sin(k * mu)
    sin, cos, tan = F.sin(foot), F.cos(foot), F.tan(foot)
    bend = 1.0 - E2 * sin * sin
    n, r = A / F.sqrt(bend), A * (1 - E2) / (bend * F.sqrt(bend))
    t, c = tan * tan, EP2 * cos * cos
    d = (easting - 500000.0) / (n * K0)
    d2 = d * d
    lat = foot - n * tan / r * d2 * (0.5 - d2 * ((5.0 + 3.0 * t + 10.0 * c - 4.0 * c * c - 9.0 * EP2) / 24.0 - d2 * (61.0 + 90.0 * t + 298.0 * c + 45.0 * t * t - 252.0 * EP2 - 3.0 * c * c) / 720.0))
    lon = d * (1.0 - d2 * ((1.0 + 2.0 * t + c) / 6.0 - d2 * (5.0 - 2.0 * c + 28.0 * t - 3.0 * c * c + 8.0 * EP2 + 24.0 * t * t) / 120.0)) / cos
    return F.degrees(lon) + _meridian(zone), F.degrees(lat)


def centroid_zone(nodes, lon: str = "lon", lat: str = "lat"):
    """One row: the zone and hemisphere of the mean node."""
    mean = nodes.agg(F.avg(lon).alias("lon"), F.avg(lat).alias("lat"))
    return mean.select(utm_zone(F.col("lon")).alias("zone"), (F.col("lat") >= 0).alias("north"), utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))
