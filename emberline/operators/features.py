"""Features of clusters: order statistics, shapes and light-curve measures."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberline.functions.geo import EARTH_KM, haversine
from emberline.functions.times import local_solar

from .joins import neighbourhood
from .linkage import seconds
from .pairs import JOINED, median_speed


def in_cluster():
    return Window.partitionBy("cid").orderBy("time", "group_id")


def numbered(members: DataFrame) -> DataFrame:
    """i from 1 by time within a cluster and n."""
    return members.withColumns({"i": F.row_number().over(in_cluster()), "n": F.count("*").over(Window.partitionBy("cid"))})


def basic(members: DataFrame) -> DataFrame:
    """Upper median time, mid-range, median position, robust maximum and total energy, time range, extent."""
    rows = numbered(members)
    at = lambda i: F.max(F.when(F.col("i") == i, F.col("time")))
    n = F.col("n")
    third = F.element_at(F.reverse(F.array_sort(F.collect_list("energy"))), 3)
    out = rows.groupBy("cid").agg(
        F.first("satellite").alias("satellite"),
        F.count("*").alias("n_groups"),
        at(F.floor(n / 2) + 1).alias("event_time"),
        at(F.floor(n / 4) + 1).alias("mid_from"),
        at(n - F.ceil(n / 4) + 1).alias("mid_to"),
        F.median("lat").alias("lat"),
        F.median("lon").alias("lon"),
        F.when(F.count("*") < 15, F.max("energy")).otherwise(third).alias("max_energy"),
        F.sum("energy").alias("total_energy"),
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        haversine(F.max("lat"), F.max("lon"), F.min("lat"), F.min("lon")).alias("ground_distance"),
    )
    return out.withColumn("duration", seconds(F.col("end_time")) - seconds(F.col("start_time")))


def _great_circle(one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    """haversine() of one (lat, lon) and others."""
    lat, lon = many
    a = np.sin(np.radians(lat - one[0]) / 2) ** 2 + np.cos(np.radians(one[0])) * np.cos(np.radians(lat)) * np.sin(np.radians(lon - one[1]) / 2) ** 2
    return 2.0 * EARTH_KM * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(0.0, 1 - a)))


def average_speed(members: DataFrame, joined: int = JOINED) -> DataFrame:
    """Median over all pairs of a cluster of distance by time, pairs of equal times left out. Pairs of clusters of `joined` rows or
    fewer are joined, larger clusters are left to median_speed()."""
    some = members.join(members.groupBy("cid").agg(F.count("*").alias("_n")).where(F.col("_n") <= joined).select("cid"), "cid", "left_semi")
    a = some.select("cid", F.col("group_id").alias("a"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), seconds(F.col("time")).alias("t1"))
    b = some.select("cid", F.col("group_id").alias("b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), seconds(F.col("time")).alias("t2"))
    dt = F.abs(F.col("t1") - F.col("t2"))
    speed = haversine(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")) / F.when(dt > 0, dt)
    small = a.join(b.hint("merge"), "cid").where("a < b").groupBy("cid").agg(F.median(speed).alias("speed"))
    rows = members.select("cid", "group_id", F.unix_micros(F.col("time").cast("timestamp")).alias("t"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    return small.unionByName(median_speed(rows, ["lat", "lon"], _great_circle, max(joined, 1) + 1))


def linearity(members: DataFrame) -> DataFrame:
    """1 - sqrt(smaller / larger eigenvalue) of the energy-weighted covariance of the positions."""
    w, x, y = F.col("energy").cast("double"), F.col("lon"), F.col("lat")
    means = members.groupBy("cid").agg((F.sum(w * x) / F.sum(w)).alias("mx"), (F.sum(w * y) / F.sum(w)).alias("my"))
    dx, dy = x - F.col("mx"), y - F.col("my")
    moments = members.join(means, "cid").groupBy("cid").agg((F.sum(w * dx * dx) / F.sum(w)).alias("a"), (F.sum(w * dx * dy) / F.sum(w)).alias("b"), (F.sum(w * dy * dy) / F.sum(w)).alias("c"))
    root = F.sqrt(F.pow(F.col("a") - F.col("c"), 2) + 4 * F.pow("b", 2))
    high, low = (F.col("a") + F.col("c") + root) / 2, F.greatest(F.lit(0.0), (F.col("a") + F.col("c") - root) / 2)
    return moments.select("cid", F.when(high > 1e-15, 1 - F.sqrt(low) / F.sqrt(high)).otherwise(0.0).alias("linearity"))


def weighted_centroid(members: DataFrame) -> DataFrame:
    w = F.col("energy")
    return members.groupBy("cid").agg((F.sum(w * F.col("lat")) / F.sum(w)).alias("lat"), (F.sum(w * F.col("lon")) / F.sum(w)).alias("lon"))


def energy_ratio(members: DataFrame) -> DataFrame:
    """Where in the time range the running energy first exceeds half of the total; 0 for no range."""
    rows = members.withColumns({"_run": F.sum("energy").over(in_cluster().rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("energy").over(Window.partitionBy("cid"))})
    t = seconds(F.col("time"))
    half = F.min(F.when(2 * F.col("_run") > F.col("_all"), t))
    out = rows.groupBy("cid").agg(half.alias("_h"), F.min(t).alias("_a"), F.max(t).alias("_b"), F.count("*").alias("_n"))
    span = F.col("_b") - F.col("_a")
    return out.select("cid", F.when((F.col("_n") < 2) | (span == 0), 0.0).otherwise((F.col("_h") - F.col("_a")) / span).alias("energy_ratio"))


def linelets(members: DataFrame, width: int = 5, bad: float = 10000.0) -> DataFrame:
    """Median residual of straight lines over tumbling windows of lon and lat against time; the last full
    window is not used unless it is the only one."""
    rows = numbered(members).withColumn("win", F.floor((F.col("i") - 1) / width))
    rows = rows.where(F.col("win") < F.greatest(F.floor(F.col("n") / width) - 1, F.lit(1)))
    t0 = F.min("time").over(Window.partitionBy("cid"))
    rows = rows.withColumn("_t", seconds(F.col("time")) - seconds(t0))

    def residual(y: str) -> Column:
        return F.when((F.count("*") > 2) & (F.regr_sxx(y, "_t") > 0), F.greatest(F.lit(0.0), F.regr_syy(y, "_t") - F.pow(F.regr_sxy(y, "_t"), 2) / F.regr_sxx(y, "_t")))

    fits = rows.groupBy("cid", "win").agg(residual("lon").alias("rx"), residual("lat").alias("ry"))
    out = fits.groupBy("cid").agg(F.median("rx").alias("rx"), F.median("ry").alias("ry"))
    return out.select("cid", F.coalesce(F.sqrt(F.pow("rx", 2) + F.pow("ry", 2)), F.lit(bad)).alias("linelet"))


def splinelets(members: DataFrame) -> DataFrame:
    """Mean over sliding windows of five energies of the squared residual of a cubic, scaled by the range
    factor (1 / max - min) squared; the last window is not used. Infinite for windows of three values or fewer."""
    rows = numbered(members)
    e = lambda k: F.lead("energy", k).over(in_cluster()).cast("double")
    res = F.pow(F.col("energy") - 4 * e(1) + 6 * e(2) - 4 * e(3) + e(4), 2) / 70
    rows = rows.withColumn("_res", res).withColumns({"_lo": F.min("energy").over(Window.partitionBy("cid")), "_hi": F.max("energy").over(Window.partitionBy("cid"))})
    rows = rows.where(F.col("i") <= F.greatest(F.col("n") - 5, F.lit(1)))
    factor = F.pow(1 / F.col("_hi") - F.col("_lo"), 2)
    return rows.groupBy("cid").agg(F.when(F.first("n") <= 3, F.lit(float("inf"))).otherwise(F.avg(F.col("_res") * factor)).alias("splinelet"))


def track_deviation(members: DataFrame, sigmas: float = 5.0) -> DataFrame:
    """Largest great-circle distance (km) from a straight ground track, outliers beyond `sigmas` robust ones left
    out: distances are taken relative to their median, and the spread is that of the relative distances.
    The track is lat over lon if the ends lie further apart in lon, else lon over lat. Distances are taken to
    1e-9 km: where most points lie on the track, rounding errors of the fit would else pass for a spread."""
    w = Window.partitionBy("cid")
    rows = numbered(members)
    end = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c))).over(w)
    rows = rows.withColumn("_flat", F.abs(end("lon", F.col("n")) - end("lon", F.lit(1))) > F.abs(end("lat", F.col("n")) - end("lat", F.lit(1))))
    rows = rows.withColumns({"_x": F.when(F.col("_flat"), F.col("lon")).otherwise(F.col("lat")), "_y": F.when(F.col("_flat"), F.col("lat")).otherwise(F.col("lon"))})
    fit = rows.groupBy("cid").agg(F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"))
    said = F.col("slope") * F.col("_x") + F.col("intercept")
    lat, lon = F.when(F.col("_flat"), said).otherwise(F.col("lat")), F.when(F.col("_flat"), F.col("lon")).otherwise(said)
    rows = rows.join(fit, "cid").select("cid", F.round(haversine(lat, lon, F.col("lat"), F.col("lon")), 9).alias("dev"))
    middle = lambda rows, value, name: rows.join(rows.groupBy("cid").agg(F.median(value).alias(name)), "cid")
    rows = middle(rows, F.col("dev"), "med")
    rows = rows.withColumn("off", F.when(F.col("med") == 0, 0.0).otherwise(F.abs(F.col("dev") - F.col("med")) / F.col("med")))
    rows = middle(middle(rows, F.col("off"), "centre"), F.abs(F.col("off") - F.col("centre")), "spread")
    kept = F.max(F.when(F.col("off") <= sigmas * 1.4826 * F.col("spread"), F.col("dev")))
    return rows.groupBy("cid").agg(F.coalesce(kept, F.max("dev")).alias("deviation"))


def chop(members: DataFrame) -> DataFrame:
    """Share of sharp falls: after a value above 1.1 thresholds the next one below the threshold counts,
    unless the four values after it are all above it. The threshold is 1.4826 times the median distance from the median."""
    rows = members.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("time", "group_id", F.col("energy").cast("double").alias("e")))).alias("m"), F.median("energy").alias("med"))
    e = F.transform("m", lambda x: x["e"])
    rows = rows.select("cid", e.alias("e"), F.array_sort(F.transform(e, lambda x: F.abs(x - F.col("med")))).alias("off"), F.size("m").alias("n"))
    at = lambda i: F.element_at("off", F.floor(i).cast("int"))
    rows = rows.withColumn("thr", (at((F.col("n") + 1) / 2) + at(F.col("n") / 2 + 1)) / 2 * 1.482602218505602)
    start = F.struct(F.lit(False).alias("up"), F.lit(0).alias("falls"))

    def step(s: Column, i: Column) -> Column:
        v = F.element_at("e", i)
        after = F.slice("e", i + 1, 4)
        outlier = F.forall(after, lambda x: x > F.col("thr"))
        fall = s["up"] & (v < F.col("thr"))
        up = F.when(~s["up"], v > 1.1 * F.col("thr")).otherwise(~(v < F.col("thr")))
        return F.struct(up.alias("up"), (s["falls"] + F.when(fall & ~outlier, 1).otherwise(0)).alias("falls"))

    steps = F.when(F.col("n") > 1, F.sequence(F.lit(1), F.col("n") - 1)).otherwise(F.array().cast("array<int>"))
    return rows.select("cid", (F.aggregate(steps, start, step)["falls"] / F.col("n")).alias("chop"))


def filled_gaps(members: DataFrame, frame: float, wide: float = 5.0) -> DataFrame:
    """Zero-energy rows every `frame` seconds in gaps of more than `wide` frames, from `wide` frames after
    the left row to `wide` frames before the right one (not included): cid, t (seconds), energy, filled."""
    rows = members.groupBy("cid", "time").agg(F.sum("energy").alias("energy")).withColumn("t", seconds(F.col("time")))
    w = Window.partitionBy("cid").orderBy("t")
    rows = rows.withColumn("next", F.lead("t").over(w))
    n = F.ceil((F.col("next") - F.col("t") - 2 * wide * frame) / frame)
    gaps = rows.where((F.col("next") - F.col("t") > wide * frame) & (n > 0)).select("cid", "t", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("k"))
    fill = gaps.select("cid", (F.col("t") + (wide + F.col("k")) * frame).alias("t"), F.lit(0).cast("long").alias("energy"), F.lit(True).alias("filled"))
    return rows.select("cid", "t", "energy", F.lit(False).alias("filled")).unionByName(fill)


def annotated(members: DataFrame, least: int, groups: DataFrame, radius_km: float, near_km: float, near_s: float, within_s: float) -> DataFrame:
    """cid, distance (km between the corners of the cluster's box), n_near (groups around it that are not its own), linearity, speed (median of pairs, null
    if all times are equal) and local_time (mean solar time of the first group), one row a cluster of `least` groups or more. members: all
    clusters; groups: all groups of all satellites."""
    around = groups.join(members.select("group_id", F.col("cid").alias("own")), "group_id", "left")
    n = members.groupBy("cid").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("cid")
    members = members.join(n, "cid", "left_semi")
    d = basic(members)
    first = members.groupBy("cid").agg(F.min_by(F.struct("time", "lon"), F.struct("time", "group_id")).alias("f"))
    out = d.select("cid", F.col("ground_distance").alias("distance")).join(neighbourhood(d, around, radius_km, near_km, near_s, within_s).select("cid", "n_near"), "cid")
    out = out.join(linearity(members), "cid").join(average_speed(members), "cid", "left").join(first, "cid")
    return out.select("cid", "distance", "n_near", "linearity", "speed", local_solar(F.col("f.time"), F.col("f.lon")).alias("local_time"))
