"""Hot spots: where density peaks off the grid, and how far they reach."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions.geo import haversine
from emberline.sources.scratch import written

from .joins import around, interval_join
from .kernels import density, density_peaks

_PLACE = "peak long, plat double, plon double"


def _weighed(points: DataFrame, peaks: DataFrame, sigma_km: float, cut: float | None) -> DataFrame:
    """Points with each peak that they add to: peak, plat, plon, lat, lon, w (Gaussian of the great-circle distance). Without a cut
    every point adds to every peak: peaks are a list no longer than the grid's maxima."""
    km = haversine(F.col("plat"), F.col("plon"), F.col("lat"), F.col("lon"))
    points = points.where("lat IS NOT NULL AND lon IS NOT NULL").select("lat", "lon")
    if cut is None:
        pairs = points.crossJoin(F.broadcast(peaks)).withColumn("km", km)
    else:
        reach = cut * sigma_km
        cell = max(0.1, 2 * reach / 111.0)
        at = F.pmod(F.col("lon") + 180.0, F.lit(360.0)) - 180.0
        pairs = interval_join(points.withColumn("_at", at), around(peaks, "plat", "plon", reach, ("_s", "_n", "_w", "_e")), [("lat", "lat", "_s", "_n", cell), ("_at", "_at", "_w", "_e", cell)]).withColumn("km", km).where(F.col("km") <= reach)
    return pairs.select("peak", "plat", "plon", "lat", "lon", F.exp(-F.col("km") * F.col("km") / (2 * sigma_km**2)).alias("w"))


def shifted(points: DataFrame, peaks: DataFrame, sigma_km: float, cut: float | None) -> DataFrame:
    """One step of mean shift: each peak (peak, plat, plon) moves to the weighted mean, on the sphere, of the points around it; with its
    density there before the step. A peak without points around it is left out."""
    p, q = F.radians("lat"), F.radians("lon")
    x, y, z = (F.sum(F.col("w") * c) for c in (F.cos(p) * F.cos(q), F.cos(p) * F.sin(q), F.sin(p)))
    sums = _weighed(points, peaks, sigma_km, cut).groupBy("peak", "plat", "plon").agg(x.alias("x"), y.alias("y"), z.alias("z"), F.sum("w").alias("density"))
    lat, lon = F.degrees(F.atan2("z", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")))), F.degrees(F.atan2("y", "x"))
    return sums.select("peak", lat.alias("plat"), lon.alias("plon"), haversine(F.col("plat"), F.col("plon"), lat, lon).alias("moved"), "density")


def peak_places(points: DataFrame, lat_step: float, lon_step: float, sigma_km: float, sigmas: float = 2.0, cut: float | None = 3.0, rounds: int = 50, tolerance_km: float = 0.01) -> DataFrame:
    """peak (from 1, densest first), lat, lon, density of the points' density peaks.

    The maxima of a grid above `sigmas` robust deviations climb by mean shift until none moves by tolerance_km or `rounds` are over;
    of peaks that end within half a sigma of a denser one only that stays. cut: sigmas beyond which a point has no weight; None weighs all.
    """
    spark = points.sparkSession
    points = written(points.select("lat", "lon"), "points")
    grid = density(points.where("lat IS NOT NULL AND lon IS NOT NULL"), lat_step, lon_step, sigma_km).withColumn("density", F.round("density", 6))
    found = density_peaks(written(grid, "density"), sigmas, lat_step, lon_step, sigma_km)
    places = [(k, r.lat, r.lon, 0.0) for k, r in enumerate(found.select("lat", "lon").orderBy("lat", "lon").collect())]  # maxima of the grid
    for _ in range(rounds):
        if not places:
            break
        step = shifted(points, spark.createDataFrame([x[:3] for x in places], _PLACE), sigma_km, cut).orderBy("peak").collect()
        places = [(r.peak, r.plat, r.plon, r.density) for r in step]
        if max((r.moved for r in step), default=0.0) <= tolerance_km:
            break
    kept: list[tuple[float, float, float]] = []
    for _, lat, lon, high in sorted(places, key=lambda x: (-round(x[3], 6), x[0])):
        if all(_km(lat, lon, a, b) > sigma_km / 2 for _, a, b in kept):
            kept.append((high, lat, lon))
    return spark.createDataFrame([(k, lat, lon, high) for k, (high, lat, lon) in enumerate(kept, 1)], "peak long, lat double, lon double, density double")


def _km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p, q, d = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(d / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(a)))


def peak_radii(points: DataFrame, peaks: DataFrame, ring_km: float = 1.0, max_km: float = 100.0, share: float = 0.1) -> DataFrame:
    """peaks with radius_km: the outer edge of the last ring before the first whose points per area are at most `share` of those of
    the densest ring, rings being ring_km wide up to max_km; max_km if there is none, null if no point is so near. peaks: peak, lat, lon."""
    rings = int(round(max_km / ring_km))
    near = _weighed(points, peaks.select("peak", F.col("lat").alias("plat"), F.col("lon").alias("plon")), max_km, 1.0)
    km = haversine(F.col("plat"), F.col("plon"), F.col("lat"), F.col("lon"))
    counts = near.select("peak", F.floor(F.round(km / ring_km, 6)).alias("ring")).where(F.col("ring") < rings).groupBy("peak", "ring").agg(F.count("*").alias("n"))
    counts = counts.withColumn("thick", F.col("n") / (2 * F.col("ring") + 1))
    spark = points.sparkSession
    grid = counts.groupBy("peak").agg(F.max("thick").alias("most"), F.min_by("ring", F.struct(-F.col("thick"), F.col("ring"))).alias("densest")).join(F.broadcast(spark.range(rings).withColumnRenamed("id", "ring")))
    thin = grid.join(counts.drop("n"), ["peak", "ring"], "left").where((F.col("ring") > F.col("densest")) & (F.coalesce("thick", F.lit(0.0)) <= share * F.col("most")))
    first = thin.groupBy("peak").agg(F.min("ring").alias("end"))
    out = peaks.join(counts.select("peak").distinct().join(first, "peak", "left").select("peak", (F.coalesce("end", F.lit(rings)) * ring_km).alias("radius_km")), "peak", "left")
    return out


def hot_spots(points: DataFrame, lat_step: float = 1.0, lon_step: float = 1.0, sigma_km: float = 100.0, sigmas: float = 2.0, cut: float | None = 3.0, n: int | None = None, max_km: float = 100.0, ring_km: float = 1.0, rounds: int = 50) -> DataFrame:
    """The n densest peaks (all without n) of points (lat, lon): peak, lat, lon, density, radius_km."""
    found = peak_places(points, lat_step, lon_step, sigma_km, sigmas, cut, rounds)
    return peak_radii(points, found if n is None else found.where(F.col("peak") <= n), ring_km, max_km)


def grid_reference(spark: SparkSession, lat_step: float, sigma_km: float, cut: float | None = 3.0) -> DataFrame:
    """y, reference: the density that one point to every square degree of the globe gives at the middle of each row of cells. It is
    the same all along a row, so it is added up over rows of the globe, a degree of longitude at a time, by great-circle distance."""
    rows = spark.range(int(-90 // lat_step), int(-(-90 // lat_step))).select(F.col("id").alias("y"), ((F.col("id") + 0.5) * lat_step).alias("plat"))
    globe = spark.range(180).select((F.col("id") - 89.5).alias("lat"))
    turn = F.explode(F.sequence(F.lit(0), F.lit(359))).alias("lon")
    reach = None if cut is None else cut * sigma_km
    pairs = rows.join(globe, F.lit(True) if reach is None else F.abs(F.col("plat") - F.col("lat")) * 111.0 <= reach).select("y", "plat", "lat", turn)
    km = haversine(F.col("plat"), F.lit(0.0), F.col("lat"), F.col("lon").cast("double"))
    pairs = pairs.withColumn("km", km)
    if reach is not None:
        pairs = pairs.where(F.col("km") <= reach)
    return pairs.groupBy("y").agg(F.sum(F.exp(-F.col("km") * F.col("km") / (2 * sigma_km**2))).alias("reference"))
