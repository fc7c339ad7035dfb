"""Geodesic and planar distances as column expressions."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in miles, metres per mile.
EARTH_RADIUS_MILES = 3958.8
METERS_PER_MILE = 1609.344

# GRS80 ellipsoid and the EPSG:5070 conic (CONUS Albers equal area).
GRS80_SEMI_MAJOR = 6378137.0
GRS80_INVERSE_FLATTENING = 298.257222101
ALBERS_PARALLEL_1 = 29.5
ALBERS_PARALLEL_2 = 45.5
ALBERS_ORIGIN_LAT = 23.0
ALBERS_ORIGIN_LON = -96.0


def angles(lat: Column, lon: Column) -> list[Column]:
    """Latitude and longitude in radians and the cosine of the latitude."""
    return [F.radians(lat), F.radians(lon), F.cos(F.radians(lat))]


def haversine_of_angles(a: list[Column], b: list[Column]) -> Column:
    half_lat, half_lon = F.sin((b[0] - a[0]) / 2), F.sin((b[1] - a[1]) / 2)
    return half_lat * half_lat + a[2] * b[2] * half_lon * half_lon


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle, 0..1; grows with the distance."""
    return haversine_of_angles(angles(lat1, lon1), angles(lat2, lon2))


def miles_of_haversine(h: Column) -> Column:
    bounded = F.when(h > 1, F.lit(1.0)).otherwise(h)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(bounded))


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle miles; NULL when any coordinate is NULL."""
    return miles_of_haversine(haversine(lat1, lon1, lat2, lon2))


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    """Point on the unit sphere; straight-line distance there grows with haversine distance."""
    phi, lam = F.radians(lat), F.radians(lon)
    return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]


def chord_of_miles(miles: float) -> float:
    """Straight-line length on the unit sphere of an arc given in miles."""
    return 2 * math.sin(min(miles / (2 * EARTH_RADIUS_MILES), math.pi / 2))


def _albers_constants() -> tuple[float, float, float, float]:
    f = 1 / GRS80_INVERSE_FLATTENING
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    p1, p2, p0 = (math.radians(x) for x in (ALBERS_PARALLEL_1, ALBERS_PARALLEL_2, ALBERS_ORIGIN_LAT))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = GRS80_SEMI_MAJOR * math.sqrt(c - n * q(p0)) / n
    return e, n, c, rho0


def albers_xy(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Forward Albers equal-area projection, metres."""
    e, n, c, rho0 = _albers_constants()
    s = F.sin(F.radians(lat))
    q = F.lit(1 - e * e) * (
        s / (1 - F.lit(e * e) * s * s) - F.log((1 - F.lit(e) * s) / (1 + F.lit(e) * s)) / F.lit(2 * e)
    )
    rho = F.lit(GRS80_SEMI_MAJOR / n) * F.sqrt(F.lit(c) - F.lit(n) * q)
    theta = F.lit(n) * F.radians(lon - F.lit(ALBERS_ORIGIN_LON))
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def point_segment_distance(
    px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column
) -> Column:
    """Planar distance from a point to a segment; a zero-length segment counts as its end."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((px - x1) * dx + (py - y1) * dy) / length2).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)
