"""Streaks: straight runs of groups in a window, found on pixels and cleaned by consensus in time.

The groups of a window become pixels, pixels edges (smoothed gradient, thinned across it, kept where a component
is strong somewhere), edges vote for lines, and the pixels of a line fall apart at gaps into segments. All of it
is joins and sums over occupied pixels: an empty image costs nothing.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberline.sources.scratch import written

from .components import components
from .linkage import seconds

#: Cells that smoothing reaches on either side, and the strengths from which a pixel counts as weak and as strong.
REACH, WEAK, STRONG = 4, 0.1, 0.2


def rasterized(rows: DataFrame, by: str, pixel_x: int, pixel_y: int) -> DataFrame:
    """rows with x and y, the pixel of latitude and longitude in the range of their window: 0 .. pixel_x - 1 and 0 .. pixel_y - 1.
    A window of one latitude or longitude has it at 0; rows without a position are left out."""
    rows = rows.where("lat IS NOT NULL AND lon IS NOT NULL")
    ends = rows.groupBy(F.col(by).alias("_by")).agg(F.min("lat").alias("_s"), F.max("lat").alias("_n"), F.min("lon").alias("_w"), F.max("lon").alias("_e"))
    at = lambda v, a, b, size: F.when(F.col(b) > F.col(a), F.floor((F.col(v) - F.col(a)) / (F.col(b) - F.col(a)) * (size - 1))).otherwise(0).cast("long")
    out = rows.join(ends, F.col(by).eqNullSafe(F.col("_by")))
    return out.withColumns({"x": at("lat", "_s", "_n", pixel_x), "y": at("lon", "_w", "_e", pixel_y)}).drop("_by", "_s", "_n", "_w", "_e")


def gradient_weights(sigma: float) -> tuple[list[float], list[float]]:
    """What a pixel adds at -REACH - 1 .. REACH + 1 from it along the derivative and across it: a Gaussian, then a difference or a sum of three."""
    bell = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / sigma) ** 2)
    bell /= bell.sum()
    return np.convolve(bell, [1.0, 0.0, -1.0]).tolist(), np.convolve(bell, [1.0, 2.0, 1.0]).tolist()


def edge_pixels(pixels: DataFrame, by: str, pixel_x: int, pixel_y: int, sigma: float = 1.0, weak: float = WEAK, strong: float = STRONG) -> DataFrame:
    """`by`, x, y, strength of the edge pixels of each window's image of occupied pixels (by: a whole number, x, y). What is outside the
    image is empty, and pixels at its border are no edges."""
    along, across = gradient_weights(sigma)
    width = len(along)
    each = pixels.select(F.col(by).alias("k"), "x", "y").distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(width * width - 1))).alias("_i"))
    i, j = F.expr(f"_i div {width}"), F.expr(f"_i % {width}")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))
    each = each.select("k", (F.col("x") + i - REACH - 1).alias("x"), (F.col("y") + j - REACH - 1).alias("y"), (pick(along, i) * pick(across, j)).alias("gx"), (pick(across, i) * pick(along, j)).alias("gy"))
    each = each.where((F.col("x") >= 0) & (F.col("x") < pixel_x) & (F.col("y") >= 0) & (F.col("y") < pixel_y))
    cells = each.groupBy("k", "x", "y").agg(F.round(F.sum("gx"), 6).alias("gx"), F.round(F.sum("gy"), 6).alias("gy"))
    cells = written(cells.withColumn("m", F.round(F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")), 6)).where("m > 0"), "gradients")
    # across the edge, in one of four directions, the strength must fall on both sides
    flat = math.tan(math.pi / 8)
    dx = F.when(F.abs("gx") < flat * F.abs("gy"), 0).otherwise(1)
    dy = F.when(F.abs("gy") < flat * F.abs("gx"), 0).when((F.col("gx") * F.col("gy") >= 0) | (dx == 0), 1).otherwise(-1)
    inside = (F.col("x") > 0) & (F.col("x") < pixel_x - 1) & (F.col("y") > 0) & (F.col("y") < pixel_y - 1)
    found = cells.where((F.col("m") >= weak) & inside).select("k", "x", "y", "m", F.explode(F.array(F.lit(-1), F.lit(1))).alias("side"), dx.alias("dx"), dy.alias("dy"))
    found = found.withColumns({"_x": F.col("x") + F.col("side") * F.col("dx"), "_y": F.col("y") + F.col("side") * F.col("dy")})
    others = cells.select(F.col("k").alias("_k"), F.col("x").alias("_ox"), F.col("y").alias("_oy"), F.col("m").alias("other"))
    found = found.join(others, (F.col("k") == F.col("_k")) & (F.col("_x") == F.col("_ox")) & (F.col("_y") == F.col("_oy")), "left")
    higher = (F.col("m") > F.coalesce("other", F.lit(0.0))) | ((F.col("m") == F.col("other")) & (F.col("side") == 1))
    thin = written(found.groupBy("k", "x", "y", "m").agg(F.bool_and(higher).alias("top")).where("top").drop("top"), "thinned")
    # weak pixels stay if a strong one is linked with them
    name = lambda x, y: F.shiftleft(F.col("k"), 40) + F.shiftleft(x.cast("long"), 20) + y.cast("long")
    named = thin.withColumn("node", name(F.col("x"), F.col("y")))
    half = [(0, 1), (1, -1), (1, 0), (1, 1)]
    near = named.select("node", F.explode(F.array(*[name(F.col("x") + a, F.col("y") + b) for a, b in half])).alias("v"))
    links = near.join(named.select(F.col("node").alias("v")), "v").select(F.col("node").alias("u"), "v")
    labels = written(components(links), "pixel-labels")
    named = named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = named.groupBy("component").agg(F.max("m").alias("best")).where(F.col("best") >= strong)
    return named.join(kept, "component").select(F.col("k").alias(by), "x", "y", F.col("m").alias("strength"))


def _votes(pixels: DataFrame, by: str, angles: int, step: float) -> DataFrame:
    theta = F.col("angle") * math.pi / angles
    rho = F.floor(F.round((F.col("x") * F.cos(theta) + F.col("y") * F.sin(theta)) / step, 6))
    return pixels.select(F.col(by).alias("k"), "x", "y", F.explode(F.sequence(F.lit(0), F.lit(angles - 1))).alias("angle")).withColumn("rho", rho)


def line_peaks(pixels: DataFrame, by: str, angles: int, step: float, threshold: int) -> DataFrame:
    """`by`, angle, rho, votes of the lines with `threshold` votes of pixels or more and no more in a line beside them (one step of
    angle or distance; of equal ones the first in the order of angle and rho)."""
    votes = written(_votes(pixels, by, angles, step).groupBy("k", "angle", "rho").agg(F.count("*").alias("votes")).where(F.col("votes") >= threshold), "votes")
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("da"), F.lit(b).alias("dr")) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]))
    other = votes.select(F.col("k").alias("_k"), "angle", "rho", F.col("votes").alias("more"), around.alias("o"))
    other = other.select("_k", (F.col("angle") + F.col("o.da")).alias("_a"), (F.col("rho") + F.col("o.dr")).alias("_r"), "more", ((F.col("o.da") > 0) | ((F.col("o.da") == 0) & (F.col("o.dr") > 0))).alias("first"))
    beaten = (F.col("more") > F.col("votes")) | ((F.col("more") == F.col("votes")) & F.col("first"))
    on = (F.col("k") == F.col("_k")) & (F.col("angle") == F.col("_a")) & (F.col("rho") == F.col("_r")) & beaten
    return votes.join(other, on, "left_anti").withColumnRenamed("k", by)


def segments(pixels: DataFrame, by: str, angles: int = 180, step: float = 1.0, threshold: int = 10, line_length: float = 120.0, line_gap: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Segments of each window and the pixels on them.

    A pixel belongs to the line with the most votes that it voted for (ties: least angle, then rho); along its line the pixels part
    where the next is more than line_gap away, and parts of line_length or more are segments: `by`, angle, rho, segment (from 1),
    n_pixels, length, x0, y0, x1, y1. pixels: `by` (a whole number), x, y, each once. Pixels: `by`, x, y, angle, rho, segment.
    """
    peaks = line_peaks(pixels, by, angles, step, threshold).withColumnRenamed(by, "k")
    cast = _votes(pixels, by, angles, step).join(peaks, ["k", "angle", "rho"])
    best = cast.groupBy("k", "x", "y").agg(F.min(F.struct((-F.col("votes")).alias("less"), "angle", "rho")).alias("b"))
    theta = F.col("angle") * math.pi / angles
    own = best.select("k", "x", "y", "b.angle", "b.rho").withColumn("s", F.round(F.col("y") * F.cos(theta) - F.col("x") * F.sin(theta), 6))
    line = Window.partitionBy("k", "angle", "rho").orderBy("s", "y", "x")  # no more pixels than a line of the image has
    own = own.withColumn("_new", F.coalesce((F.col("s") - F.lag("s").over(line) > line_gap).cast("int"), F.lit(1)))
    own = own.withColumn("segment", F.sum("_new").over(line)).drop("_new")
    place = F.struct("s", "y", "x")
    rows = own.groupBy("k", "angle", "rho", "segment").agg(F.count("*").alias("n_pixels"), F.round(F.max("s") - F.min("s"), 4).alias("length"), F.min(place).alias("a"), F.max(place).alias("z")).where(F.col("length") >= line_length)
    rows = rows.select(F.col("k").alias(by), "angle", "rho", "segment", "n_pixels", "length", F.col("a.x").alias("x0"), F.col("a.y").alias("y0"), F.col("z.x").alias("x1"), F.col("z.y").alias("y1"))
    keys = [by, "angle", "rho", "segment"]
    return rows, own.drop("s").withColumnRenamed("k", by).join(rows.select(*keys), keys, "left_semi")


# --- consensus in time -------------------------------------------------------------------------------

#: Primes of the picks of three rows: what they are is of no matter, but the picks are the same wherever they are made.
PICKS = ((7919, 104729, 15485863), (6971, 99991, 32452843), (5309, 86969, 49979687))
PICK_RANGE = 1000003


def _pick(n: int) -> Column:
    a, b, c = PICKS[n]
    return F.pmod(F.col("h") * a + F.pmod(F.col("cid"), F.lit(PICK_RANGE)) * b + c, F.lit(PICK_RANGE))


def consensus_lines(members: DataFrame, trials: int = 50, least_r2: float | None = None, width: float | None = None) -> DataFrame:
    """cid, n, n_inliers, slope_lon, slope_lat, r2, mse of time (minutes from the first row) over longitude and latitude, one row a cluster.

    Each of `trials` planes goes through three rows picked by a hash; all planes of all clusters are scored in one aggregate. The plane
    with the most rows within `width` minutes (default: the median deviation of the times from their median) wins, then the one of
    the least squared error, then the first. Least squares over its rows give the slopes, r2 and mse; clusters with less than least_r2 are
    left out. Three rows on one line give the plane that is level across it, three in one place none. Clusters of fewer than three
    rows, or all in one place, have no row; r2 is null where all times of the rows are equal, and slopes are null where they lie on one line.
    """
    w = Window.partitionBy("cid").orderBy("time", "group_id")
    rows = members.where("time IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL").select("cid", "group_id", "lat", "lon", "time").withColumn("i", F.row_number().over(w) - 1)
    ends = rows.groupBy("cid").agg(F.count("*").alias("n"), F.min("time").alias("t0"), F.min_by("lat", "i").alias("lat0"), F.min_by("lon", "i").alias("lon0")).where("n >= 3")
    rows = rows.join(ends, "cid").select("cid", "i", "n", (F.col("lon") - F.col("lon0")).alias("x"), (F.col("lat") - F.col("lat0")).alias("y"), ((seconds(F.col("time")) - seconds(F.col("t0"))) / 60).alias("z"))
    rows = written(rows, "consensus-rows")
    spread = rows.groupBy("cid").agg(F.median("z").alias("middle"))
    spread = rows.join(spread, "cid").groupBy("cid").agg(F.median(F.abs(F.col("z") - F.col("middle"))).alias("width"))
    picks = rows.select("cid", "n").distinct().withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))).withColumn("h", F.col("h").cast("long"))
    one = F.pmod(_pick(0), F.col("n"))
    two = F.pmod(one + 1 + F.pmod(_pick(1), F.col("n") - 1), F.col("n"))
    three = F.pmod(_pick(2), F.col("n") - 2)
    three = three + (three >= F.least(one, two)).cast("long")
    three = three + (three >= F.greatest(one, two)).cast("long")
    picks = picks.select("cid", "h", F.inline(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("long").alias("i")) for k, v in enumerate((one, two, three))])))
    at = lambda c, k: F.max(F.when(F.col("k") == k, F.col(c)))
    three_rows = picks.join(rows.select("cid", F.col("i").cast("long").alias("i"), "x", "y", "z"), ["cid", "i"]).groupBy("cid", "h").agg(*[at(c, k).alias(f"{c}{k}") for c in "xyz" for k in range(3)])
    d = lambda c, k: F.col(f"{c}{k}") - F.col(f"{c}0")
    det = F.round(d("x", 1) * d("y", 2) - d("x", 2) * d("y", 1), 12)
    long = [d("x", k) * d("x", k) + d("y", k) * d("y", k) for k in (1, 2)]
    far = lambda c: F.when(long[0] >= long[1], d(c, 1)).otherwise(d(c, 2))
    steep = F.when(F.round(F.greatest(*long), 12) > 0, far("z") / F.greatest(*long))  # along the line of three rows on one
    a = F.when(det != 0, (d("z", 1) * d("y", 2) - d("z", 2) * d("y", 1)) / det).otherwise(steep * far("x"))
    b = F.when(det != 0, (d("x", 1) * d("z", 2) - d("x", 2) * d("z", 1)) / det).otherwise(steep * far("y"))
    planes = three_rows.select("cid", "h", a.alias("a"), b.alias("b"), "x0", "y0", "z0").where("a IS NOT NULL AND b IS NOT NULL")
    planes = planes.groupBy("cid").agg(F.collect_list(F.struct("h", "a", "b", "x0", "y0", "z0")).alias("planes"))  # `trials` at most
    limit = F.lit(float(width)) if width is not None else F.col("width")
    scored = rows.join(planes.join(spread, "cid"), "cid").select("cid", "x", "y", "z", limit.alias("limit"), F.inline("planes"))
    scored = scored.withColumn("off", F.round(F.abs(F.col("z") - F.col("z0") - F.col("a") * (F.col("x") - F.col("x0")) - F.col("b") * (F.col("y") - F.col("y0"))), 6)).where("off <= limit")
    scored = scored.groupBy("cid", "h", "a", "b", "x0", "y0", "z0", "limit").agg(F.count("*").alias("m"), F.round(F.sum(F.col("off") * F.col("off")), 4).alias("error"))
    best = scored.groupBy("cid").agg(F.min(F.struct((-F.col("m")).alias("less"), "error", "h", "a", "b", "x0", "y0", "z0", "limit")).alias("p"))
    p = lambda c: F.col(f"p.{c}")
    kept = rows.join(best, "cid").where(F.round(F.abs(F.col("z") - p("z0") - p("a") * (F.col("x") - p("x0")) - p("b") * (F.col("y") - p("y0"))), 6) <= p("limit"))
    moments = {c: F.avg(c) for c in "xyz"} | {"xx": F.covar_pop("x", "x"), "xy": F.covar_pop("x", "y"), "yy": F.covar_pop("y", "y"), "xz": F.covar_pop("x", "z"), "yz": F.covar_pop("y", "z"), "zz": F.covar_pop("z", "z")}
    fit = kept.groupBy("cid", "n").agg(F.count("*").alias("n_inliers"), *[v.alias(c) for c, v in moments.items()])
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    plane = F.round(det, 15) > 0
    slope_x = F.when(plane, (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / det)
    slope_y = F.when(plane, (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / det)
    # on one line the fit is the one along it
    along = F.when(F.col("xx") >= F.col("yy"), F.when(F.col("xx") > 0, F.col("xz") * F.col("xz") / F.col("xx"))).otherwise(F.col("yz") * F.col("yz") / F.col("yy"))
    told = F.when(plane, slope_x * F.col("xz") + slope_y * F.col("yz")).otherwise(F.coalesce(along, F.lit(0.0)))
    r2 = F.when(F.round("zz", 9) > 0, told / F.col("zz"))
    out = fit.select("cid", "n", "n_inliers", slope_x.alias("slope_lon"), slope_y.alias("slope_lat"), r2.alias("r2"), F.greatest(F.col("zz") - told, F.lit(0.0)).alias("mse"))
    return out if least_r2 is None else out.where(F.col("r2") >= least_r2)


def streaks(rows: DataFrame, by: str, pixel_x: int = 1372, pixel_y: int = 1300, clean: bool = True, least_r2: float = 0.0, trials: int = 1000, reach: int = 1, **line) -> tuple[DataFrame, DataFrame]:
    """The groups on each window's segments (rows with cid, the number of their segment) and the segments, in the order of the method: pixels, edges, lines,
    segments, the groups within `reach` pixels of theirs (a thin line has its edges beside it), and with `clean` only segments whose times
    agree with a plane by least_r2 or more. A group near two segments is in both. by: a whole number."""
    placed = written(rasterized(rows, by, pixel_x, pixel_y), "raster")
    edges = written(edge_pixels(placed, by, pixel_x, pixel_y), "edges")
    found, pixels = segments(edges, by, **line)
    keys = [by, "angle", "rho", "segment"]
    found = written(found.withColumn("cid", F.xxhash64(*keys)), "segments")
    around = lambda c: F.explode(F.sequence(F.col(c) - reach, F.col(c) + reach)).alias(c)
    on = pixels.join(found.select(*keys, "cid"), keys).select(by, "cid", "y", around("x")).select(by, "cid", "x", around("y")).distinct()
    held = placed.join(on, [by, "x", "y"]).drop("x", "y")
    if not clean:
        return held, found
    fits = written(consensus_lines(held, trials, least_r2), "fits")
    return held.join(fits.select("cid"), "cid", "left_semi"), found.join(fits.drop("n"), "cid")
