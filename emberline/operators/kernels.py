"""What built-in expressions cannot say: small array computations on one cluster's rows at a time."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _km(lat1, lon1, lat2, lon2):
    p, q = np.radians(lat1), np.radians(lat2)
    a = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(0, 1 - a)))


def split_in_turns(t: np.ndarray, lat: np.ndarray, lon: np.ndarray, km: float, seconds: float) -> np.ndarray:
    """The part of each row, rows in the order of t (microseconds). A turn looks only at rows that are new within
    `seconds` of the last one and at those that the part has passed over."""
    part, n, first = np.full(len(t), -1), 0, 0
    ends = np.searchsorted(t, t + round(seconds * 1e6), "left")
    while first < len(t):
        last, seen, passed = first, first + 1, np.zeros(0, np.int64)
        part[last] = n
        while True:
            new = np.arange(seen, max(seen, ends[last]))
            seen += len(new)
            at = np.concatenate([passed, new[part[new] < 0]])
            near = (at < ends[last]) & (_km(lat[at], lon[at], lat[last], lon[last]) < km)  # a turn may lead back in time
            if not near.any():
                break
            part[at[near]] = n
            last, passed = int(at[near][-1]), at[~near]
        rest = np.flatnonzero(part[first:seen] < 0)
        first = first + int(rest[0]) if len(rest) else seen
        while first < len(t) and part[first] >= 0:
            first += 1
        n += 1
    return part


def sequential_split(members: DataFrame, km: float, seconds: float) -> DataFrame:
    """cid, part, group_id: a cluster split in turns. The first remaining row opens a part, which takes in
    all rows within km whose time is less than `seconds` after that of the row it took in last."""

    def split(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["t", "group_id"])
        part = split_in_turns(g["t"].to_numpy(), g["lat"].to_numpy(), g["lon"].to_numpy(), km, seconds)
        return pd.DataFrame({"cid": g["cid"], "part": part, "group_id": g["group_id"]})

    rows = members.select("cid", "group_id", F.unix_micros(F.col("time").cast("timestamp")).alias("t"), "lat", "lon")
    return rows.groupBy("cid").applyInPandas(split, "cid long, part long, group_id long")


def smoothed(y: np.ndarray, window: int) -> np.ndarray:
    """Cubic least squares in a sliding window; the ends are read off the first and last window. Memory grows with
    the rows and with four columns of the window, time with the rows and their logarithm."""
    half = window // 2
    level = y[0]
    y = y - level  # what does not change stays as it is, exactly
    basis, _ = np.linalg.qr(np.vander((np.arange(window) - half) / max(1, half), 4, increasing=True))
    size = 1 << (len(y) + window - 1).bit_length()
    weights = basis @ basis[half]
    out = np.fft.irfft(np.fft.rfft(y, size) * np.fft.rfft(weights[::-1], size), size)[half : half + len(y)]
    out[:half] = basis[:half] @ (basis.T @ y[:window])
    out[-half:] = basis[-half:] @ (basis.T @ y[-window:])
    return out + level


def without_outliers(members: DataFrame, least: int = 25, clips: dict[str, float] | None = None, sigmas: float = 10.0) -> DataFrame:
    """cid, group_id of the rows whose energy and position stay near a smooth course: within the larger of
    `sigmas` robust deviations and a clip. Clusters under `least` rows are kept as they are."""
    clips = clips or {"energy": 0.0, "lat": 0.15, "lon": 0.15}

    def clean(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["time", "group_id"])
        window = len(g) // 5
        window += window % 2 == 0
        ok = np.ones(len(g), bool)
        if len(g) >= least and window >= 5:
            for c, clip in clips.items():
                r = g[c].to_numpy(float) - smoothed(g[c].to_numpy(float), window)
                sigma = 1.4826 * np.median(np.abs(r - np.median(r)))
                ok &= np.abs(r) <= max(sigmas * sigma, clip)
        return g.loc[ok, ["cid", "group_id"]]

    return members.select("cid", "group_id", "time", "lat", "lon", F.col("energy").cast("double").alias("energy")).groupBy("cid").applyInPandas(clean, "cid long, group_id long")


def pchip(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Monotone cubic Hermite interpolation; NaN outside the range."""
    h, d = np.diff(x), np.diff(y) / np.diff(x)
    m = np.zeros(len(x))
    if len(x) == 2:
        m[:] = d[0]
    else:
        w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            inner = (w1 + w2) / (w1 / d[:-1] + w2 / d[1:])
        m[1:-1] = np.where(d[:-1] * d[1:] > 0, inner, 0)
        for end, (a, b, p, q) in ((0, (h[0], h[1], d[0], d[1])), (-1, (h[-1], h[-2], d[-1], d[-2]))):
            s = ((2 * a + b) * p - a * q) / (a + b)
            m[end] = 0 if s * p <= 0 else 3 * p if p * q < 0 and abs(s) > 3 * abs(p) else s
    i = np.clip(np.searchsorted(x, at, "right") - 1, 0, len(x) - 2)
    t = (at - x[i]) / h[i]
    out = (2 * t**3 - 3 * t**2 + 1) * y[i] + (t**3 - 2 * t**2 + t) * h[i] * m[i] + (-2 * t**3 + 3 * t**2) * y[i + 1] + (t**3 - t**2) * h[i] * m[i + 1]
    return np.where((at < x[0]) | (at > x[-1]), np.nan, out)


def light_curves(members: DataFrame, seconds: float, points: int) -> DataFrame:
    """cid, curve: the energy at `points` times around the peak, `seconds` wide; 0 where there is none."""

    def resample(g: pd.DataFrame) -> pd.DataFrame:
        g = g.groupby("time", as_index=False)["energy"].sum().sort_values("time").assign(cid=g["cid"].iloc[0])
        t, e = g["time"].astype("int64").to_numpy() / 1e9, g["energy"].to_numpy(float)
        curve = np.zeros(points)
        if len(t) > 1:
            at = t[int(e.argmax())] + np.linspace(-seconds / 2, seconds / 2, points)
            curve = np.nan_to_num(pchip(t, e, at))
        return pd.DataFrame({"cid": [g["cid"].iloc[0]], "curve": [curve]})

    return members.select("cid", "time", "energy").groupBy("cid").applyInPandas(resample, "cid long, curve array<double>")


def stretched_curves(members: DataFrame, points: int) -> DataFrame:
    """cid, curve: the energy at `points` times evenly over the whole time range; clusters of one time are zero."""

    def resample(g: pd.DataFrame) -> pd.DataFrame:
        cid = g["cid"].iloc[0]
        g = g.groupby("time", as_index=False)["energy"].sum().sort_values("time")
        t, e = g["time"].astype("int64").to_numpy() / 1e9, g["energy"].to_numpy(float)
        curve = pchip(t - t[0], e, np.linspace(0, t[-1] - t[0], points)) if len(t) > 1 else np.zeros(points)
        return pd.DataFrame({"cid": [cid], "curve": [curve]})

    return members.select("cid", "time", "energy").groupBy("cid").applyInPandas(resample, "cid long, curve array<double>")


def density(points: DataFrame, lat_step: float, lon_step: float, sigma_km: float, per_degree: bool = False) -> DataFrame:
    """Gaussian density (y, x, density) on a grid: points are counted by cell, and a cell adds to the cells within
    three sigma, east and west by its latitude, so the work grows with occupied cells, not with points times grid.
    With per_degree it is divided by what one point to every square degree gives there."""
    cells = points.groupBy(F.floor(F.col("lat") / lat_step).alias("y"), F.floor(F.col("lon") / lon_step).alias("x")).agg(F.count("*").alias("n"))
    narrow = F.greatest(F.lit(0.01), F.cos(F.radians((F.col("y") + 0.5) * lat_step)))
    ry, rx = math.ceil(3 * sigma_km / 111.19 / lat_step), F.ceil(3 * sigma_km / 111.19 / lon_step / narrow)
    spread = cells.withColumn("dx", F.explode(F.sequence(-rx, rx))).withColumn("dy", F.explode(F.sequence(F.lit(-ry), F.lit(ry))))
    d2 = F.pow(F.col("dy") * lat_step * 111.19, 2) + F.pow(F.col("dx") * lon_step * 111.19 * narrow, 2)
    weight = F.col("n") * F.exp(-d2 / (2 * sigma_km**2))
    out = spread.groupBy((F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x")).agg(F.sum(weight).alias("density"))
    even = 2 * math.pi * sigma_km**2 / (111.19**2 * narrow)
    return out.withColumn("density", F.col("density") / even) if per_degree else out


def density_peaks(cells: DataFrame, sigmas: float, lat_step: float, lon_step: float, sigma_km: float) -> DataFrame:
    """Cells denser than `sigmas` robust deviations and than the eight around them (ties to the smaller y, x), with the
    place of the peak by a parabola through its neighbours on either axis, and the radius (km) of a circle as wide as
    the kernel at the peak's curvature: y, x, density, lat, lon, radius_km."""
    centre = cells.agg(F.median("density").alias("m"))
    spread = cells.crossJoin(F.broadcast(centre)).agg((1.4826 * F.median(F.abs(F.col("density") - F.col("m")))).alias("s"))
    by = F.explode(F.array(*[F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]))
    near = cells.select("y", "x", F.col("density").alias("other"), by.alias("o")).select((F.col("y") - F.col("o.dy")).alias("y"), (F.col("x") - F.col("o.dx")).alias("x"), "other", "o.dy", "o.dx")
    high = cells.crossJoin(F.broadcast(spread)).where(F.col("density") > sigmas * F.col("s")).drop("s")
    beats = (F.col("density") > F.col("other")) | ((F.col("density") == F.col("other")) & ((F.col("dy") > 0) | ((F.col("dy") == 0) & (F.col("dx") > 0))))
    at = lambda i, j: F.coalesce(F.max(F.when((F.col("dy") == i) & (F.col("dx") == j), F.col("other"))), F.lit(0.0))
    rows = high.join(near, ["y", "x"], "left").groupBy("y", "x", "density").agg(
        F.coalesce(F.bool_and(beats), F.lit(True)).alias("top"), at(-1, 0).alias("s"), at(1, 0).alias("n"), at(0, -1).alias("w"), at(0, 1).alias("e")
    )
    bend = lambda a, b: F.col(a) - 2 * F.col("density") + F.col(b)
    shift = lambda a, b: F.when(bend(a, b) < 0, (F.col(a) - F.col(b)) / (2 * bend(a, b))).otherwise(0.0)
    curved = -bend("s", "n") / (F.col("density") * (lat_step * 111.19) ** 2)
    lat, lon = (F.col("y") + 0.5 + shift("s", "n")) * lat_step, (F.col("x") + 0.5 + shift("w", "e")) * lon_step
    radius = F.when(curved > 0, 1 / F.sqrt(curved)).otherwise(sigma_km)
    return rows.where("top").select("y", "x", "density", lat.alias("lat"), lon.alias("lon"), radius.alias("radius_km"))


def hough_votes(points: DataFrame, angles: int, step: float) -> DataFrame:
    """Votes of pixels (x, y) for lines: theta in `angles` steps of a half turn, rho in steps."""
    theta = F.explode(F.sequence(F.lit(0), F.lit(angles - 1)))
    rows = points.select("x", "y", theta.alias("k"))
    rho = F.floor(F.round((F.col("x") * F.cos(F.col("k") * math.pi / angles) + F.col("y") * F.sin(F.col("k") * math.pi / angles)) / step, 6))
    return rows.groupBy("k", rho.alias("rho")).agg(F.count("*").alias("votes"))
