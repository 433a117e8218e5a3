"""Height of events that two geostationary satellites see, and what follows from it."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.geo import GEO_KM, WGS84_A, WGS84_B, haversine

from .joins import time_cells
from .linkage import seconds
from .pairs import JOINED, median_speed

#: How far the ellipsoid of navigated positions lies above WGS-84 at equator and poles (km), and the
#: range of heights above it.
EQUATOR_KM, POLE_KM, MOST_KM = 16.0, 6.0, 500.0
_GOLDEN = (math.sqrt(5.0) - 1) / 2


def _position(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates on the ellipsoid of navigated positions."""
    a, b = WGS84_A + EQUATOR_KM, WGS84_B + POLE_KM
    p, q, flat = F.radians(lat), F.radians(lon), (b / a) ** 2
    n = a / F.sqrt(1 - (1 - flat) * F.pow(F.sin(p), 2))
    return n * F.cos(p) * F.cos(q), n * F.cos(p) * F.sin(q), n * flat * F.sin(p)


def _satellite(sat_lon: float) -> tuple[float, float]:
    return GEO_KM * math.cos(math.radians(sat_lon)), GEO_KM * math.sin(math.radians(sat_lon))


def _at_height(sat_lon: float, direction: tuple[Column, Column, Column], h: Column) -> tuple[Column, Column, Column]:
    """Where a line of sight enters the ellipsoid h above that of navigated positions."""
    (sx, sy), (dx, dy, dz) = _satellite(sat_lon), direction
    aa, bb = F.pow(h + WGS84_A + EQUATOR_KM, 2), F.pow(h + WGS84_B + POLE_KM, 2)
    qa = (dx * dx + dy * dy) / aa + dz * dz / bb
    qb = 2 * (sx * dx + sy * dy) / aa
    qc = (sx * sx + sy * sy) / aa - 1
    root = qb * qb - 4 * qa * qc
    t = (-qb - F.sqrt(F.when(root >= 0, root))) / (2 * qa)
    return sx + t * dx, sy + t * dy, t * dz


def _place(p: tuple[Column, Column, Column], h: Column) -> tuple[Column, Column]:
    x, y, z = p
    ratio = F.pow((h + WGS84_A + EQUATOR_KM) / (h + WGS84_B + POLE_KM), 2)
    return F.degrees(F.atan2(z * ratio, F.sqrt(x * x + y * y))), F.degrees(F.atan2(y, x))


def _apart(p: tuple[Column, Column, Column], q: tuple[Column, Column, Column]) -> Column:
    return F.sqrt(sum((F.pow(a - b, 2) for a, b in zip(p, q)), F.lit(0.0)))


def seen_from(lat: Column, lon: Column, height_km: Column, sat_lon: float) -> tuple[Column, Column]:
    """The navigated position of a point at `height_km` above the ellipsoid of navigated positions."""
    h = height_km
    a, b = h + WGS84_A + EQUATOR_KM, h + WGS84_B + POLE_KM
    p, q, flat = F.radians(lat), F.radians(lon), F.pow(b / a, 2)
    n = a / F.sqrt(1 - (1 - flat) * F.pow(F.sin(p), 2))
    sx, sy = _satellite(sat_lon)
    direction = n * F.cos(p) * F.cos(q) - sx, n * F.cos(p) * F.sin(q) - sy, n * flat * F.sin(p)
    return _place(_at_height(sat_lon, direction, F.lit(0.0)), F.lit(0.0))


def _meeting_height(one: tuple[float, float], other: tuple[float, float], rounds: int):
    """A column function: the height at which the lines of sight of two satellites pass closest."""

    @F.pandas_udf("double")
    def solve(x1: pd.Series, y1: pd.Series, z1: pd.Series, x2: pd.Series, y2: pd.Series, z2: pd.Series) -> pd.Series:
        d1, d2 = (np.stack([np.asarray(c, float) for c in line]) for line in ((x1, y1, z1), (x2, y2, z2)))

        def at(sat, d, h):
            s, axes = np.array([[sat[0]], [sat[1]], [0.0]]), np.stack([h + WGS84_A + EQUATOR_KM, h + WGS84_A + EQUATOR_KM, h + WGS84_B + POLE_KM]) ** 2
            a, b, c = (d * d / axes).sum(0), 2 * (s * d / axes).sum(0), (s * s / axes).sum(0) - 1
            return s + (-b - np.sqrt(b * b - 4 * a * c)) / (2 * a) * d

        def miss(h):
            return np.nan_to_num(np.linalg.norm(at(one, d1, h) - at(other, d2, h), axis=0), nan=np.inf)

        low, high = np.zeros(len(x1)), np.full(len(x1), MOST_KM)
        with np.errstate(invalid="ignore"):
            for _ in range(rounds):
                left, right = high - _GOLDEN * (high - low), low + _GOLDEN * (high - low)
                nearer = miss(left) < miss(right)
                low, high = np.where(nearer, low, left), np.where(nearer, right, high)
        known = np.isfinite(d1).all(0) & np.isfinite(d2).all(0)
        return pd.Series((low + high) / 2).where(known)

    return solve


def altitudes(pairs: DataFrame, sat_1: float, sat_2: float, rounds: int = 40) -> DataFrame:
    """Height at which two lines of sight pass closest, and the places there.

    pairs: lat1, lon1, lat2, lon2, navigated positions of one event by satellites at longitudes sat_1 and sat_2.
    Adds alt (km above the ellipsoid of navigated positions, 0 to 500), residual (km between the two places),
    place_lat1, place_lon1, place_lat2, place_lon2, x, y, z (of the first). The least distance is found by
    golden section, a fixed number of steps on whole Arrow batches. Heights of null positions are null.
    """
    rows, sights = pairs, []
    for k, sat in ((1, sat_1), (2, sat_2)):
        (x, y, z), (sx, sy) = _position(F.col(f"lat{k}"), F.col(f"lon{k}")), _satellite(sat)
        rows = rows.withColumns({f"_x{k}": x - sx, f"_y{k}": y - sy, f"_z{k}": z})
        sights.append((sat, (F.col(f"_x{k}"), F.col(f"_y{k}"), F.col(f"_z{k}"))))
    lines = [c for _, direction in sights for c in direction]
    rows = rows.withColumn("alt", _meeting_height(_satellite(sat_1), _satellite(sat_2), rounds)(*lines))
    p, q = (_at_height(*sight, F.col("alt")) for sight in sights)
    (a1, o1), (a2, o2) = _place(p, F.col("alt")), _place(q, F.col("alt"))
    return rows.withColumns({"residual": _apart(p, q), "place_lat1": a1, "place_lon1": o1, "place_lat2": a2, "place_lon2": o2, "x": p[0], "y": p[1], "z": p[2]}).drop(*[f"_{c}{k}" for c in "xyz" for k in (1, 2)])


def _straight(one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    return np.sqrt(sum((c - x) ** 2 for x, c in zip(one, many, strict=True)))


def medians(points: DataFrame, joined: int = JOINED) -> DataFrame:
    """Median height, residual and speed of each cid; speed is the median over all pairs of points of distance in
    space by time, pairs of equal times left out. points: cid, group_id, t, x, y, z, alt, residual. Pairs of cids of `joined`
    points or fewer are joined, larger ones are left to median_speed()."""
    some = points.join(points.groupBy("cid").agg(F.count("*").alias("_n")).where(F.col("_n") <= joined).select("cid"), "cid", "left_semi")
    a = some.select("cid", F.col("group_id").alias("g1"), F.col("t").alias("t1"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("z").alias("z1"))
    b = some.select("cid", F.col("group_id").alias("g2"), F.col("t").alias("t2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("z").alias("z2"))
    dt = F.abs(F.col("t1") - F.col("t2"))
    km = _apart((F.col("x1"), F.col("y1"), F.col("z1")), (F.col("x2"), F.col("y2"), F.col("z2")))
    speed = a.join(b.hint("merge"), "cid").where("g1 < g2").groupBy("cid").agg(F.median(km / F.when(dt > 0, dt)).alias("speed"))
    rows = points.select("cid", "group_id", F.round(F.col("t") * 1e6).cast("long").alias("t"), "x", "y", "z")
    speed = speed.unionByName(median_speed(rows, ["x", "y", "z"], _straight, max(joined, 1) + 1))
    return points.groupBy("cid").agg(F.median("alt").alias("alt"), F.median("residual").alias("residual")).join(speed, "cid", "left")


def extent(points: DataFrame) -> DataFrame:
    """Diagonals of each cid's bounding boxes in space and on the ground (km), NaN left out."""
    real = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    span = lambda c: F.max(real(c)) - F.min(real(c))
    ground = haversine(F.max(real("lat")), F.max(real("lon")), F.min(real("lat")), F.min(real("lon")))
    return points.groupBy("cid").agg(F.sqrt(F.pow(span("x"), 2) + F.pow(span("y"), 2) + F.pow(span("z"), 2)).alias("max_dist"), ground.alias("max_ground_track"))


def outside_limits(alt_1: Column, alt_2: Column, least: float, most: float | None = None) -> Column:
    """Whether both median heights are below `least`, or both above `most` if it is given."""
    out = (alt_1 < least) & (alt_2 < least)
    return out if most is None else out | ((alt_1 > most) & (alt_2 > most))


def worth_a_report(alt_1: Column, alt_2: Column, least: float) -> Column:
    """Whether either median height reaches `least`; an unknown one does not."""
    return F.coalesce(alt_1 >= least, F.lit(False)) | F.coalesce(alt_2 >= least, F.lit(False))


def surroundings(detections: DataFrame, groups: DataFrame, km: float = 500.0, within_s: float = 2.0) -> DataFrame:
    """Groups of a detection's satellite within km of it and within_s of its median time: cid, group_id.
    detections: cid, satellite, lat, lon, t0 (seconds). They meet in cells of time and latitude."""
    deg = km / 111.0
    d = detections.select("cid", "satellite", F.col("lat").alias("lat0"), F.col("lon").alias("lon0"), "t0")
    d = time_cells(d, F.col("t0") - within_s, F.col("t0") + within_s, within_s)
    d = time_cells(d, F.col("lat0") - deg, F.col("lat0") + deg, deg, "band")
    g = groups.select("group_id", "satellite", "lat", "lon", seconds(F.col("time")).alias("t"))
    g = g.withColumns({"cell": F.floor(F.col("t") / within_s), "band": F.floor(F.col("lat") / deg)})
    near = (haversine(F.col("lat0"), F.col("lon0"), F.col("lat"), F.col("lon")) <= km) & (F.abs(F.col("t") - F.col("t0")) <= within_s)
    # neither the groups nor what a detection is dealt to: a table's estimate is of its packed files
    return d.join(g.hint("merge"), ["satellite", "cell", "band"]).where(near).select("cid", "group_id")
