"""Profiles of detections: filters, re-association, merging, beliefs and counts."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberline.functions.geo import EARTH_KM, corridor_km, fixed_grid, haversine, unwrap_lon

from .linkage import seconds
from .scoring import validation_state


@dataclass(frozen=True)
class Box:
    """A box in space and time; with `streak_km` the strip of that half width around its diagonal instead."""

    lat_lo: float
    lat_hi: float
    lon_lo: float
    lon_hi: float
    start: str
    end: str
    streak_km: float | None = None

    def holds(self, lat: Column, lon: Column, time: Column) -> Column:
        lon = unwrap_lon(lon)
        if self.streak_km is None:
            place = lat.between(self.lat_lo, self.lat_hi) & lon.between(self.lon_lo, self.lon_hi)
        else:
            place = corridor_km(lat, lon, self.lat_lo, self.lon_lo, self.lat_hi, self.lon_hi) <= self.streak_km
        return place & time.between(F.lit(self.start).cast("timestamp"), F.lit(self.end).cast("timestamp"))


def in_boxes(detections: DataFrame, boxes: list[Box]) -> DataFrame:
    """Detections whose median position and time lie in any of a list of boxes; all of them for no list."""
    if not boxes:
        return detections
    hit = F.lit(False)
    for b in boxes:
        hit = hit | b.holds(F.col("lat"), F.col("lon"), F.col("event_time"))
    return detections.where(hit)


def between_dates(rows: DataFrame, start: str, end: str, time: str = "event_time") -> DataFrame:
    """Rows from start to end, both included; a date alone is its midnight."""
    return rows.where(F.col(time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def day_window(files: DataFrame, start: str, end: str, pad_seconds: float = 50.0) -> DataFrame:
    """Files within [start - pad, end + pad]. A bound that is a date alone sets no bound."""
    pad = F.make_dt_interval(secs=F.lit(pad_seconds))
    if len(start) > 10:
        files = files.where(F.col("start") >= F.lit(start).cast("timestamp") - pad)
    if len(end) > 10:
        files = files.where(F.col("end") <= F.lit(end).cast("timestamp") + pad)
    return files


def valid_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles with a time, a size and at least one opinion (n_opinions)."""
    return profiles.where(F.col("event_time").isNotNull() & F.col("n_groups").isNotNull() & (F.coalesce("n_opinions", F.lit(0)) > 0))


def at_least(rows: DataFrame, belief: str, least: float) -> DataFrame:
    """Rows whose belief reaches `least`; no belief is not enough."""
    return rows.where(F.col(belief) >= least)


@dataclass(frozen=True)
class Scene:
    """What an imager sees: limits of its full disk, of the lightning mapper, and the grid of its regional scene."""

    satellite: str
    lon0: float
    disk: tuple[float, float]  # west and east; west > east crosses the date line
    mapper: tuple[float, float]
    x_offset: float


#: Limits of the scenes in degrees and of the regional grid in radians.
DISK_LAT, MAPPER_LAT = 81.3282, 66.56
GRID_STEP, Y_OFFSET, GRID_X, GRID_Y = 2.8e-05, 0.128226, 5000, 3000
EAST = Scene("east", -75.0, (-156.2995, 6.2995), (-141.56, -8.44), -0.101346)
WEST = Scene("west", -137.0, (141.7005, -55.7005), (156.44, -70.44), -0.069986)


def in_scene(lat: Column, lon: Column, scene: Scene, half: float = 5.0) -> tuple[Column, Column]:
    """Whether a window of `half` degrees lies in the full disk, and whether it lies in the regional scene too."""
    north, south, west, east = lat + half, lat - half, lon - half, lon + half

    def within(value: Column, limits: tuple[float, float]) -> Column:
        return (value >= limits[0]) & (value <= limits[1]) if limits[0] <= limits[1] else (value >= limits[0]) | (value <= limits[1])

    disk = (north <= DISK_LAT) & (south >= -DISK_LAT) & within(west, scene.disk) & within(east, scene.disk) & lat.between(-MAPPER_LAT, MAPPER_LAT) & within(lon, scene.mapper)
    region = disk
    for a in (north, south):
        for o in (west, east):
            x, y, _ = fixed_grid(a, o, scene.lon0)
            region = region & ((x - scene.x_offset) / GRID_STEP).between(0, GRID_X) & ((Y_OFFSET - y) / GRID_STEP).between(0, GRID_Y)
    return disk, region


def in_frame(x: Column, y: Column, nx: int, ny: int) -> Column:
    return (x >= 0) & (x < nx) & (y >= 0) & (y < ny)


def one_to_one(ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The one row of each id. No row or more than one is an error, raised when the result is read."""
    found = ids.select(key).join(rows.withColumn("_found", F.lit(True)), key, "left")
    found = found.withColumn("_n", F.count("*").over(Window.partitionBy(key)))
    checked = F.assert_true((F.col("_n") == 1) & F.coalesce("_found", F.lit(False)), F.lit("an id without exactly one row"))
    return found.where(checked.isNull()).drop("_n", "_found")


def with_scores(detections: DataFrame, scores: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Detections with the score of their id, null where there is none; several are an error."""
    once = scores.groupBy(key).agg(F.max(score).alias(score), F.count("*").alias("_n"))
    checked = F.assert_true(F.coalesce("_n", F.lit(1)) == 1, F.lit("several scores of one id"))
    return detections.join(once, key, "left").where(checked.isNull()).drop("_n")


def belief_of_truth(matches: DataFrame, truth: DataFrame, belief: Column) -> DataFrame:
    """cid and belief: the mean belief of the truth events that it matched (one a satellite), 0 for none.
    matches: cid, truth_idx, a row for each satellite; belief is a column expression on truth."""
    known = truth.select(F.col("idx").alias("truth_idx"), belief.alias("_b"))
    return matches.join(known, "truth_idx", "left").groupBy("cid").agg(F.coalesce(F.avg("_b"), F.lit(0.0)).alias("belief"))


def members_of(clusters: DataFrame, groups: DataFrame) -> DataFrame:
    """The group rows of clusters' member lists, found again by file and id (an id counts within its file alone)."""
    ids = clusters.select("cid", F.explode("members").alias("m")).select("cid", F.col("m.dataset_file").alias("dataset_file"), F.col("m.group_id").alias("group_id"))
    return ids.join(groups, ["dataset_file", "group_id"])


def _running_mean(values: Column) -> Column:
    """Mean of the mean so far and the next value, from the first value on: the order matters."""
    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values), F.lit(1))), F.element_at(values, 1), lambda a, b: (a + b) / 2)


def _joined_names(names: Column) -> Column:
    """Names put together, those that the text so far holds left out."""
    rest = F.slice(names, 2, F.greatest(F.size(names), F.lit(1)))
    return F.aggregate(rest, F.element_at(names, 1), lambda a, b: F.when(F.contains(a, b), a).otherwise(F.concat(F.lit("Combined: "), a, F.lit(" + "), b)))


def merged_detections(detections: DataFrame, key: str, order: str) -> DataFrame:
    """One detection a key: members in time order, running means of scores, methods joined, in `order`.
    Detections of one key from several satellites are an error. Rows: satellite, members, score, method."""
    one = F.struct(order, "satellite", "members", "score", "method")
    rows = detections.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("_d"), F.countDistinct("satellite").alias("_s"))
    checked = F.assert_true(F.col("_s") == 1, F.lit("detections of several satellites"))
    return rows.where(checked.isNull()).select(
        key,
        F.col("_d")[0]["satellite"].alias("satellite"),
        F.array_sort(F.flatten(F.col("_d.members"))).alias("members"),
        _running_mean(F.col("_d.score")).alias("score"),
        _joined_names(F.col("_d.method")).alias("method"),
        F.size("_d").alias("n"),
    )


#: Features that only the groups can give again.
LOST_WHEN_COMBINED = ("linelet", "energy_ratio", "splinelet", "deviation", "chop", "glint", "neighbourhood", "linearity")


def combined_features(features: DataFrame, key: str, order: str, lost: tuple[str, ...] = LOST_WHEN_COMBINED) -> DataFrame:
    """Features of the detections of a key as those of one: running midpoints of time and place in `order`,
    widest ranges, sums of size, energy and track, the least distance to each hot spot. The largest energy
    is that of the first; `lost` features are null."""
    t = seconds(F.col("event_time"))
    one = F.struct(F.col(order), t.alias("t"), "lat", "lon", "dist", "max_energy")
    rows = features.groupBy(key).agg(
        F.array_sort(F.collect_list(one)).alias("_d"),
        F.min("mid_from").alias("mid_from"),
        F.max("mid_to").alias("mid_to"),
        F.sum("total_energy").alias("total_energy"),
        F.sum("n_groups").alias("n_groups"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("ground_distance").alias("ground_distance"),
    )
    d = F.col("_d")
    spots = F.aggregate(F.slice(d["dist"], 2, F.greatest(F.size(d), F.lit(1))), d[0]["dist"], lambda a, b: F.zip_with(a, b, lambda x, y: F.least(x, y)))
    kept = ["mid_from", "mid_to", "total_energy", "n_groups", "start_time", "end_time", "ground_distance"]
    return rows.select(
        key,
        F.timestamp_micros((_running_mean(d["t"]) * 1e6).cast("long")).alias("event_time"),
        _running_mean(d["lat"]).alias("lat"),
        _running_mean(d["lon"]).alias("lon"),
        *kept,
        d[0]["max_energy"].alias("max_energy"),
        spots.alias("dist"),
        (seconds(F.col("end_time")) - seconds(F.col("start_time"))).alias("duration"),
        *[F.lit(None).cast("double").alias(c) for c in lost],
    )


def profiles(detections: DataFrame, rejections: DataFrame, source: str) -> DataFrame:
    """Detections and rejections with the belief of one source (triage, validation or human), each from its
    own row: cid, is_detection, belief, method."""
    if source not in ("triage", "validation", "human"):
        raise ValueError(f"no such source of beliefs: {source}")
    pick = lambda rows, kind: rows.select("cid", F.lit(kind).alias("is_detection"), F.col(f"{source}_score").alias("belief"), F.col(f"{source}_method").alias("method"))
    return pick(detections, True).unionByName(pick(rejections, False))


def evaluated(detections: DataFrame, scores: DataFrame, low: float, high: float, triage: float, forced_groups: int) -> DataFrame:
    """Scores written back to detections by id, and the state that follows: those that triage accepts or that
    have `forced_groups` groups are candidates at least."""
    rows = with_scores(detections, scores.withColumnRenamed("score", "validation_score"), "cid", "validation_score")
    forced = (F.col("score") >= triage) | (F.col("n_groups") >= forced_groups)
    return rows.withColumn("state", validation_state(F.col("validation_score"), low, high, F.coalesce(forced, F.lit(False))))


def truth_mode(detections: DataFrame, matches: DataFrame, truth: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """Rows of days that hold truth: all that match a truth event, and `share` of the others by a seeded hash
    (kind: detection or rejection)."""
    days = truth.select(F.to_date("time").alias("_day")).distinct()
    rows = detections.join(matches, "cid").withColumn("_day", F.to_date("event_time")).join(days, "_day", "left_semi").drop("_day")
    u = F.pmod(F.xxhash64("cid", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return rows.withColumn("kind", F.when(F.col("truth_idx") >= 0, "detection").otherwise("rejection")).where((F.col("kind") == "detection") | (u <= share))


def verdict_counts(verdicts: DataFrame, column: str = "verdict") -> DataFrame:
    """tp, fp, unc and how many rows say something else or nothing."""
    v = F.col(column)
    return verdicts.agg(F.count_if(v == "TP").alias("tp"), F.count_if(v == "FP").alias("fp"), F.count_if(v == "UNC").alias("unc"), F.count_if(~F.coalesce(v.isin("TP", "FP", "UNC"), F.lit(False))).alias("errors"))


def sample_of(rows: DataFrame, k: int, key: str, seed: int = 0) -> DataFrame:
    """k rows, those of the smallest seeded hash: the same for every layout of the input."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(k)


def glint_distance(lat: Column, lon: Column, glint_lat: Column, glint_lon: Column) -> Column:
    """Distance to the glint point; half of the Earth's circumference where it is hidden (null)."""
    return F.coalesce(haversine(lat, lon, glint_lat, glint_lon), F.lit(math.pi * EARTH_KM))


def slider_of_belief(belief: Column, low: int, high: int) -> Column:
    """A belief from 0 to 1 as a slider's step, halves to the even one."""
    return (F.bround(belief * float(high - low), 0) + low).cast("int")


def belief_of_slider(score: Column, low: int, high: int) -> Column:
    return (score - low) / float(high - low)


def view_box(points: DataFrame, key: str, margin: float) -> DataFrame:
    """Centre of each key's positions, nulls and NaN left out, and the box `margin` degrees around them."""
    clean = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    la, lo = clean("lat"), clean("lon")
    return points.groupBy(key).agg(
        F.avg(la).alias("lat"), F.avg(lo).alias("lon"), (F.min(la) - margin).alias("lat_lo"), (F.max(la) + margin).alias("lat_hi"), (F.min(lo) - margin).alias("lon_lo"), (F.max(lo) + margin).alias("lon_hi")
    )


def in_order_of_parts(names: DataFrame, parts: list[str], column: str = "name") -> DataFrame:
    """Names whose last path part holds one of `parts`, once for each, numbered by the list's order then the name's:
    part, name."""
    base = F.element_at(F.split(F.col(column), "/"), -1)
    hits = F.array(*[F.when(base.contains(p), F.struct(F.lit(i).alias("i"), F.lit(p).alias("part"))) for i, p in enumerate(parts)])
    return names.select(F.col(column).alias("name"), F.explode(F.array_compact(hits)).alias("p")).select(F.col("p.i").alias("part_no"), F.col("p.part").alias("part"), "name")


def precision_band(curves: DataFrame, steps: int = 2000, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Mean and band of precision and recall over folds at `steps` thresholds: each fold's curve (fold, score,
    precision, recall) gives every threshold its nearest point, halves to the lower one. A point takes a range
    of thresholds, so no threshold meets every point."""
    w = Window.partitionBy("fold").orderBy("score")
    border = lambda other: F.floor(F.round((F.col("score") + other) / 2 * steps, 6)).cast("long")
    first = F.coalesce(border(F.lag("score").over(w)) + 1, F.lit(0).cast("long"))
    last = F.coalesce(border(F.lead("score").over(w)), F.lit(steps - 1).cast("long"))
    rows = curves.withColumns({"_a": F.greatest(first, F.lit(0).cast("long")), "_b": F.least(last, F.lit(steps - 1).cast("long"))}).where("_a <= _b")
    rows = rows.select("precision", "recall", F.explode(F.sequence("_a", "_b")).alias("step"))
    both = [(c, n) for c in ("precision", "recall") for n in ("mean", "low", "high")]
    how = {"mean": F.avg, "low": lambda c: F.percentile(c, F.lit(low)), "high": lambda c: F.percentile(c, F.lit(high))}
    return rows.groupBy("step").agg(*[how[n](c).alias(f"{c}_{n}") for c, n in both])


def streak_statistics(rows: DataFrame, key: str) -> DataFrame:
    """Minutes, ends and path length of each key's points in time order."""
    w = Window.partitionBy(key).orderBy("time", "group_id")
    lon = F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180
    steps = rows.withColumn("lon", lon).withColumn("_km", haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")))
    at = F.struct("time", "group_id")
    return steps.groupBy(key).agg(
        ((seconds(F.max("time")) - seconds(F.min("time"))) / 60).alias("minutes"),
        F.min_by("lat", at).alias("start_lat"),
        F.min_by("lon", at).alias("start_lon"),
        F.max_by("lat", at).alias("end_lat"),
        F.max_by("lon", at).alias("end_lon"),
        F.coalesce(F.sum("_km"), F.lit(0.0)).alias("km"),
    )


def turned(pixels: DataFrame, size: int) -> DataFrame:
    """Pixels (sample, x, y) of square images with turns (quarter turns) and flip of their sample applied, all
    pixels of a sample alike."""
    n = size - 1
    x, y = F.when(F.col("flip"), n - F.col("x")).otherwise(F.col("x")), F.col("y")
    tx = F.when(F.col("turns") == 1, y).when(F.col("turns") == 2, n - x).when(F.col("turns") == 3, n - y).otherwise(x)
    ty = F.when(F.col("turns") == 1, n - x).when(F.col("turns") == 2, n - y).when(F.col("turns") == 3, x).otherwise(y)
    return pixels.withColumns({"x": tx, "y": ty})


def usable_images(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Long table (cid, image, name) of the image files of profiles that were cut out, are square and have every
    column of `columns`."""
    full = (F.col("cutout") & (F.col("height") == F.col("width")))
    for c in columns:
        full = full & F.col(c).isNotNull()
    each = F.array(*[F.struct(F.lit(c).alias("image"), F.col(c).alias("name")) for c in columns])
    return rows.where(F.coalesce(full, F.lit(False))).select("cid", F.explode(each).alias("i")).select("cid", "i.image", "i.name")


def combined_by_match(profiles: DataFrame, match: str = "truth_idx", order: str = "cid") -> DataFrame:
    """Profiles (cid, n_groups, score, match) of one truth event as one: the first in order keeps the match, with the sum of the groups, the largest
    score and how many it stands for (n_combined); the others get match -99. Profiles without a match (below 0 or null) stay as they are."""
    best = profiles.where(F.col(match) >= 0).groupBy(F.col(match).alias("_match")).agg(F.min(order).alias("_first"), F.sum("n_groups").alias("_groups"), F.max("score").alias("_score"), F.count("*").alias("_n"))
    rows = profiles.join(best, F.col(match) == F.col("_match"), "left")
    first = F.col("_first") == F.col(order)
    new = {
        match: F.when(F.col("_match").isNull() | first, F.col(match)).otherwise(F.lit(-99).cast("long")),
        "n_groups": F.when(first, F.col("_groups")).otherwise(F.col("n_groups")),
        "score": F.when(first, F.col("_score")).otherwise(F.col("score")),
        "n_combined": F.when(first, F.col("_n")).otherwise(F.lit(1).cast("long")),
    }
    return rows.withColumns(new).select(*profiles.columns, "n_combined")
