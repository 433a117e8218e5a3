"""Suppression around hot spots: how well given radii and strengths tell true from false, and which do best."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.sources.scratch import written


def suppression_histogram(scored: DataFrame, spots: int, max_radius: float = 100.0, km: float = 0.1, step: float = 0.001) -> DataFrame:
    """d, score, t, f: true and false rows by score (rounded to `step`) and distances to the spots (rounded up to `km`; null
    beyond max_radius, where no radius reaches). scored: score, is_true, distances (array). Rows without a score or truth are left out.

    Most rows are beyond all spots, so the histogram has about as many rows as there are different scores, whatever the data.
    """
    near = lambda k: F.element_at("distances", k + 1)
    d = F.array(*[F.when(near(k) <= max_radius, F.round(F.ceil(F.round(near(k) / km, 6)) * km, 6)) for k in range(spots)])
    rows = scored.where("score IS NOT NULL AND is_true IS NOT NULL").select(d.alias("d"), F.round(F.round(F.col("score") / step) * step, 9).alias("score"), "is_true")
    return rows.groupBy("d", "score").agg(F.count_if("is_true").alias("t"), F.count_if(~F.col("is_true")).alias("f"))


def likelihood_ratios(histogram: DataFrame, points: list[tuple[list[float], list[float]]], target: float = 0.5) -> DataFrame:
    """point, threshold, tpr, fpr, ratio for each point (radii, strengths): a score falls by the strength of the first spot
    whose radius holds it, to 0 at least; the threshold is the score nearest the target (of two the higher); ratio is tpr / fpr,
    fpr counting as half a row at least. All points are evaluated in one aggregation."""
    spots = len(points[0][0])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("point"), F.array(*[F.lit(float(v)) for v in r]).alias("r"), F.array(*[F.lit(float(v)) for v in a]).alias("a")) for i, (r, a) in enumerate(points)]))
    rows = histogram.select("*", each.alias("p"))
    fall: Column = F.lit(0.0)
    for k in range(spots - 1, -1, -1):
        fall = F.when(F.element_at("d", k + 1) <= F.element_at("p.r", k + 1), F.element_at("p.a", k + 1)).otherwise(fall)
    score = F.round(F.least(F.greatest(F.col("score") - fall, F.lit(0.0)), F.lit(1.0)), 6)
    counts = rows.select(F.col("p.point").alias("point"), score.alias("s"), "t", "f").groupBy("point", "s").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
    nearest = F.min(F.struct(F.round(F.abs(F.col("s") - target), 9).alias("off"), (-F.col("s")).alias("less")))
    # no more scores to a point than steps in [0, 1]
    lists = counts.groupBy("point").agg(nearest.alias("n"), F.collect_list(F.struct("s", "t", "f")).alias("all"), F.sum("t").alias("true_rows"), F.sum("f").alias("false_rows"))
    above = lambda c: F.aggregate("all", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["s"] >= F.col("threshold"), x[c]).otherwise(0))
    out = lists.withColumn("threshold", -F.col("n.less")).withColumns({"tp": above("t"), "fp": above("f")})
    tpr, fpr = F.col("tp") / F.nullif(F.col("true_rows"), F.lit(0)), F.col("fp") / F.nullif(F.col("false_rows"), F.lit(0))
    return out.select("point", "threshold", tpr.alias("tpr"), fpr.alias("fpr"), (tpr / F.greatest(fpr, 0.5 / F.col("false_rows"))).alias("ratio"))


@dataclass
class Suppression:
    """What optimise_suppression() found: radii (km) and strengths by spot, the ratio there and before, the weight of a kilometre, and the rounds taken."""

    radii: list[float]
    strengths: list[float]
    ratio: float
    before: float
    gamma: float
    rounds: int


def optimise_suppression(scored: DataFrame, spots: int, target: float = 0.5, max_radius: float = 100.0, least_strength: float = 0.1, rounds: int = 80, tolerance: float = 1e-3) -> Suppression:
    """Radii (0.5 .. max_radius) and strengths (least_strength .. 1) that make the likelihood ratio large and the radii small.

    A kilometre of radius costs gamma, so much that full strength at max_radius everywhere gains nothing. The search is a simplex: each
    round asks for the reflected, stretched and both drawn-in points and for the whole shrunken simplex at once, one aggregation over the
    histogram, and moves on the driver, which holds 2 * spots + 1 points.
    """
    histogram = written(suppression_histogram(scored, spots, max_radius), "histogram")

    def ratios(points: np.ndarray) -> np.ndarray:
        found = likelihood_ratios(histogram, [(p[0::2].tolist(), p[1::2].tolist()) for p in points], target).select("point", "ratio").collect()
        out = np.full(len(points), -np.inf)
        for r in found:
            out[r.point] = -np.inf if r.ratio is None else r.ratio
        return out

    low, high = np.tile([0.5, least_strength], spots), np.tile([max_radius, 1.0], spots)
    before, full = ratios(np.array([np.tile([-1.0, 0.0], spots), np.tile([max_radius, 1.0], spots)]))
    gamma = max(0.0, (full - before) / (spots * max_radius)) if np.isfinite([before, full]).all() else 0.0
    merits = lambda points: ratios(points) - gamma * points[:, 0::2].sum(axis=1)
    start = np.tile([max_radius - 1.0, least_strength], spots)
    simplex = np.array([start] + [np.where(np.arange(2 * spots) == k, (low + high) / 2 if k % 2 == 0 else high, start) for k in range(2 * spots)])
    value = merits(simplex)
    done = 0
    while done < rounds:
        order = np.argsort(-value, kind="stable")
        simplex, value = simplex[order], value[order]
        if np.abs((simplex[1:] - simplex[0]) / (high - low)).max() < tolerance:
            break
        done += 1
        centre, worst = simplex[:-1].mean(axis=0), simplex[-1]
        moves = [centre + k * (centre - worst) for k in (1.0, 2.0, 0.5, -0.5)]
        asked = np.clip(np.vstack([moves, simplex[0] + 0.5 * (simplex[1:] - simplex[0])]), low, high)
        got = merits(asked)
        reflected, stretched, outside, inside = got[:4]
        if reflected > value[0]:
            best = 1 if stretched > reflected else 0
        elif reflected > value[-2]:
            best = 0
        elif reflected > value[-1] and outside >= reflected:
            best = 2
        elif reflected <= value[-1] and inside > value[-1]:
            best = 3
        else:
            simplex[1:], value[1:] = asked[4:], got[4:]
            continue
        simplex[-1], value[-1] = asked[best], got[best]
    best = int(np.argmax(value))
    return Suppression(simplex[best][0::2].tolist(), simplex[best][1::2].tolist(), float(value[best] + gamma * simplex[best][0::2].sum()), float(before), float(gamma), done)
