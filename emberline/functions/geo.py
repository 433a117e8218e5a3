"""Positions on the globe as column expressions. Degrees in, kilometres out, unless said otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean Earth radius (km), geostationary radius (km), WGS-84 axes (km).
EARTH_KM, GEO_KM = 6371.0, 42164.0
WGS84_A, WGS84_B = 6378.137, 6356.752314245


def wrap_lon(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def unwrap_lon(lon: Column, beyond: float = 150.0) -> Column:
    """Longitudes above `beyond` as negative ones, so that the Pacific is one piece."""
    return F.when(lon > beyond, lon - 360.0).otherwise(lon)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    """Great-circle distance; radius 180/pi gives degrees."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Bearing in radians in [0, 2 pi), counted with west positive."""
    d = F.radians(lon1 - lon2)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.atan2(y, x), F.lit(2 * math.pi))


def destination(lat: Column, lon: Column, bearing_deg: Column, km: Column) -> tuple[Column, Column]:
    """The point `km` from a point in a direction (degrees, east of north)."""
    d, b, p = km / EARTH_KM, F.radians(bearing_deg), F.radians(lat)
    lat2 = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(b))
    lon2 = F.radians(lon) + F.atan2(F.sin(b) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(lat2))
    return F.degrees(lat2), wrap_lon(F.degrees(lon2))


def circle(lat: Column, lon: Column, km: Column, points: int = 36) -> Column:
    """Points of a circle around a point: array of (bearing, lat, lon)."""

    def point(i: Column) -> Column:
        angle = i * (360.0 / points)
        to_lat, to_lon = destination(lat, lon, angle, km)
        return F.struct(angle.alias("bearing"), to_lat.alias("lat"), to_lon.alias("lon"))

    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), point)


def midpoint(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> tuple[Column, Column]:
    """Half way on the great circle."""
    p1, p2, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    bx, by = F.cos(p2) * F.cos(d), F.cos(p2) * F.sin(d)
    lat = F.atan2(F.sin(p1) + F.sin(p2), F.sqrt(F.pow(F.cos(p1) + bx, 2) + F.pow(by, 2)))
    return F.degrees(lat), wrap_lon(lon1 + F.degrees(F.atan2(by, F.cos(p1) + bx)))


def ellipse_radius(phi: Column, along: Column, across: Column) -> Column:
    """Radius of a region at angle phi: `along` and `across` are its extents in the two directions."""
    return (along - across) / 2 * (F.sin(2 * phi + math.pi / 2) + 1) + across


def corridor_km(lat: Column, lon: Column, lat1: float, lon1: float, lat2: float, lon2: float) -> Column:
    """Distance from a segment whose closest point is found in the plane of degrees."""
    dx, dy = lon2 - lon1, lat2 - lat1
    length = dx * dx + dy * dy
    t = F.lit(0.0) if length == 0 else F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((lon - lon1) * dx + (lat - lat1) * dy) / length))
    return haversine(lat, lon, lat1 + t * dy, lon1 + t * dx)


def to_ecef(lat: Column, lon: Column, height_km: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates (km) of a geodetic position."""
    e2 = 1 - (WGS84_B / WGS84_A) ** 2
    p, q = F.radians(lat), F.radians(lon)
    n = WGS84_A / F.sqrt(1 - e2 * F.pow(F.sin(p), 2))
    return (n + height_km) * F.cos(p) * F.cos(q), (n + height_km) * F.cos(p) * F.sin(q), (n * (1 - e2) + height_km) * F.sin(p)


def from_ecef(x: Column, y: Column, z: Column, rounds: int = 6) -> tuple[Column, Column, Column]:
    """Geodetic latitude, longitude (degrees) and height (km): a fixed number of fixed-point steps."""
    e2 = 1 - (WGS84_B / WGS84_A) ** 2
    r = F.sqrt(x * x + y * y)
    lat = F.atan2(z, r * (1 - e2))
    for _ in range(rounds):
        n = WGS84_A / F.sqrt(1 - e2 * F.pow(F.sin(lat), 2))
        lat = F.atan2(z + e2 * n * F.sin(lat), r)
    n = WGS84_A / F.sqrt(1 - e2 * F.pow(F.sin(lat), 2))
    height = r * F.cos(lat) + (z + e2 * n * F.sin(lat)) * F.sin(lat) - n
    return F.degrees(lat), F.degrees(F.atan2(y, x)), height


def renavigated(lat: Column, lon: Column, from_km: float, to_km: Column | float, sat_lon: float) -> tuple[Column, Column]:
    """Where the line of sight from a geostationary satellite, seen at height `from_km`, passes `to_km`.

    The position is put on the ellipsoid raised by from_km, and the ray from the satellite through it is
    cut with the ellipsoid raised by to_km. Null where the ray misses it.
    """
    to_km = F.lit(to_km) if not isinstance(to_km, Column) else to_km
    x, y, z = to_ecef(lat, lon, F.lit(float(from_km)))
    sx, sy = GEO_KM * math.cos(math.radians(sat_lon)), GEO_KM * math.sin(math.radians(sat_lon))
    dx, dy, dz = x - sx, y - sy, z
    a, b = WGS84_A + to_km, WGS84_B + to_km
    qa = (dx * dx + dy * dy) / (a * a) + dz * dz / (b * b)
    qb = 2 * (F.lit(sx) * dx + F.lit(sy) * dy) / (a * a)
    qc = (sx * sx + sy * sy) / (a * a) - 1
    root = qb * qb - 4 * qa * qc
    t = (-qb - F.sqrt(F.when(root >= 0, root))) / (2 * qa)
    px, py, pz = sx + t * dx, sy + t * dy, t * dz
    return F.degrees(F.atan2(pz * (a * a) / (b * b), F.sqrt(px * px + py * py))), F.degrees(F.atan2(py, px))


def fixed_grid(lat: Column, lon: Column, sat_lon: float) -> tuple[Column, Column, Column]:
    """Scan angles (x, y in radians) of a position in a geostationary imager's grid, and whether it is in view."""
    p, d = F.radians(lat), F.radians(lon - sat_lon)
    e2 = 1 - (WGS84_B / WGS84_A) ** 2
    c = F.atan((WGS84_B / WGS84_A) ** 2 * F.tan(p))
    rc = WGS84_B / F.sqrt(1 - e2 * F.pow(F.cos(c), 2))
    sx = GEO_KM - rc * F.cos(c) * F.cos(d)
    sy = -rc * F.cos(c) * F.sin(d)
    sz = rc * F.sin(c)
    visible = GEO_KM * (GEO_KM - sx) >= sy * sy + (WGS84_A / WGS84_B) ** 2 * sz * sz
    return F.asin(-sy / F.sqrt(sx * sx + sy * sy + sz * sz)), F.atan2(sz, sx), visible
