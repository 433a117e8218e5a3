"""Queries of suppression, exact samples, applied classifiers and annotation rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.operators import classifier, features, joins, sampling, scoring, tuning
from emberline.sources import point_events as pe
from emberline.sources.scratch import written

from .cluster_queries import _DET, clusters, detections, matched, scored
from .common import CLOSENESS_S, LEAST_GROUPS, hav, query, with_members
from .scalar_queries import ALPHAS, RADII, SPOTS

_POINTS = [([20.0, 40.0], [0.6, 0.8]), ([5.0, 90.0], [0.3, 0.1]), ([-1.0, -1.0], [0.0, 0.0]), ([100.0, 100.0], [1.0, 1.0]), ([2.5, 2.5], [0.5, 0.2])]
_VALUES = ", ".join(f"({i}, CAST({r[0]} AS DOUBLE), CAST({r[1]} AS DOUBLE), CAST({a[0]} AS DOUBLE), CAST({a[1]} AS DOUBLE))" for i, (r, a) in enumerate(_POINTS))


@query(with_members(f""", {_DET}, s AS (SELECT round(round(score / 0.001) * 0.001, 9) AS score, truth_idx >= 0 AS is_true, {hav('lat', 'lon', '1.0', '-75.0')} AS e1, {hav('lat', 'lon', '18.0', '-137.0')} AS e2 FROM d JOIN match USING (cid)),
    h AS (SELECT score, is_true, CASE WHEN e1 <= 100 THEN round(ceil(round(e1 / 0.1, 6)) * 0.1, 6) END AS d1, CASE WHEN e2 <= 100 THEN round(ceil(round(e2 / 0.1, 6)) * 0.1, 6) END AS d2 FROM s),
    p(point, r1, r2, a1, a2) AS (VALUES {_VALUES}), x AS (SELECT point, is_true, round(least(greatest(score - CASE WHEN d1 <= r1 THEN a1 WHEN d2 <= r2 THEN a2 ELSE 0.0 END, 0.0), 1.0), 6) AS s FROM h, p),
    b AS (SELECT point, arg_min(s, (round(abs(s - 0.5), 9), -s)) AS threshold, count(*) FILTER (is_true) AS nt, count(*) FILTER (NOT is_true) AS nf FROM x GROUP BY point),
    c AS (SELECT point, threshold, count(*) FILTER (is_true AND s >= threshold) / CAST(any_value(nt) AS DOUBLE) AS tpr, count(*) FILTER (NOT is_true AND s >= threshold) / CAST(any_value(nf) AS DOUBLE) AS fpr, any_value(nf) AS nf FROM x JOIN b USING (point) GROUP BY point, threshold)
    SELECT CAST(point AS INTEGER) AS point, round(threshold, 6) AS threshold, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(tpr / greatest(fpr, 0.5 / nf), 5) AS ratio FROM c"""))
def m08_likelihood_ratios(spark, sf_dir):
    d, m = matched(spark, sf_dir)
    rows = d.join(m, "cid").select("score", (F.col("truth_idx") >= 0).alias("is_true"), joins.hotspot_distances(None, SPOTS).alias("distances"))
    out = tuning.likelihood_ratios(tuning.suppression_histogram(rows, 2), _POINTS)
    return out.select("point", *[F.round(c, 6).alias(c) for c in ("threshold", "tpr", "fpr")], F.round("ratio", 5).alias("ratio"))


#: A portable seeded order of clusters, and its cells.
_HASH = "(cid * 7919 + 1361477) % 1000003"


def _order():
    return {"order": F.expr(_HASH), "cell": F.floor(F.expr(_HASH) / 4096)}


@query(with_members(f", {_DET} SELECT cid, CASE WHEN i <= CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT) THEN 'train' WHEN i <= CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT) + CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS part FROM (SELECT cid, row_number() OVER (ORDER BY {_HASH}, cid) AS i, count(*) OVER () AS n FROM d)"))
def m03_split(spark, sf_dir):
    return sampling.split(written(detections(spark, sf_dir).select("cid"), "split"), "cid", {"train": 0.6, "val": 0.2, "test": 0.2}, **_order())


@query(with_members(f", {_DET}, s AS (SELECT cid, truth_idx >= 0 AS is_true FROM d JOIN match USING (cid)), rk AS (SELECT *, row_number() OVER (PARTITION BY is_true ORDER BY {_HASH}, cid) AS i, count(*) FILTER (is_true) OVER () AS p FROM s) SELECT cid, is_true FROM rk WHERE is_true OR i <= round_even(p / CAST(0.75 AS DOUBLE), 0) - p"))
def m04_rebalance(spark, sf_dir):
    return sampling.rebalanced(scored(spark, sf_dir).select("cid", "is_true"), F.col("is_true"), 0.75, "cid", **_order())


_DRAWS = 500


@query(with_members(f""", {_DET}, s AS (SELECT cid, 1.0 / CAST(count(*) OVER (PARTITION BY truth_idx >= 0) * 2 AS DOUBLE) AS w FROM d JOIN match USING (cid)),
    u AS (SELECT cid, CAST(round(w / (SELECT sum(w) FROM s) * 1000000000000) AS HUGEINT) AS units FROM s), ru AS (SELECT cid, units, sum(units) OVER (ORDER BY {_HASH}, cid) AS upto, sum(units) OVER () AS total FROM u),
    o AS (SELECT *, CAST((5 * 104729 + 7919) AS HUGEINT) * 1000003 % CAST(total AS HUGEINT) AS off FROM ru), t AS (SELECT cid, CAST(((CAST(upto AS HUGEINT) - units) * {_DRAWS} + off) // CAST(total AS HUGEINT) AS BIGINT) AS a, CAST((CAST(upto AS HUGEINT) * {_DRAWS} + off) // CAST(total AS HUGEINT) AS BIGINT) AS b FROM o)
    SELECT cid, b - a AS times FROM t WHERE b > a"""))
def m05_weighted_draws(spark, sf_dir):
    weighted = written(scoring.class_weights(scored(spark, sf_dir), "is_true").select("cid", "weight"), "weighted")
    return sampling.drawn(weighted, "weight", _DRAWS, "cid", 5, **_order()).groupBy("cid").agg(F.count("*").alias("times"))


_SCALING = {"n_groups": "robust", "total_energy": "robust", "max_energy": "robust", "duration": "minmax", "ground_distance": "minmax", "energy_ratio": "standard"}


@query()
def m06_forest_scores(spark, sf_dir):
    """Triage scores of a seeded random forest on cluster features, learned from truth matches of one part of the clusters; `part` says which rows it has not seen.
    Where that part is empty nothing is learned: scores are null, as those of detections without a classifier are."""
    d, m = matched(spark, sf_dir)
    ratio = features.energy_ratio(clusters(spark, sf_dir))
    rows = d.drop("score").join(m, "cid").join(ratio, "cid").withColumn("belief", F.when(F.col("truth_idx") >= 0, 1.0).when(F.col("truth_idx") == -1, 0.0))
    rows = written(sampling.split(written(rows, "profiles"), "cid", {"train": 0.6, "test": 0.4}, **_order()), "profiles")
    matrix = classifier.feature_matrix(rows, list(_SCALING), "belief")
    train = matrix.where("part = 'train'")
    if train.isEmpty():
        return matrix.select("cid", "part", F.lit(None).cast("double").alias("score"))
    model = classifier.fit(train, _SCALING)
    return classifier.scored(model, matrix).select("cid", "part", F.round("score", 4).alias("score"))


@query(with_members(f""", {_DET}, a AS (SELECT cid, n_groups, CASE WHEN cid % 13 <> 0 THEN score * 1.25 - 0.1 END AS raw, CASE WHEN {hav('lat', 'lon', '1.0', '-75.0')} <= 20 THEN 0.6 WHEN {hav('lat', 'lon', '18.0', '-137.0')} <= 1500 THEN 0.8 ELSE 0.0 END AS alpha FROM d),
    b AS (SELECT cid, n_groups > 15 AS forced, CASE WHEN raw IS NOT NULL THEN least(greatest(raw - alpha, 0.0), 1.0) END AS score FROM a)
    SELECT cid, forced, round(score, 6) AS score, CASE WHEN forced THEN 'accepted' WHEN score IS NULL THEN 'N/A' WHEN score < 0.4 THEN 'rejected' ELSE 'accepted' END AS triage,
        CASE WHEN forced AND (score IS NULL OR score < 0.9) THEN 'candidate' WHEN score IS NULL THEN 'N/A' WHEN score < 0.5 THEN 'rejected' WHEN score < 0.9 THEN 'candidate' ELSE 'accepted' END AS validation FROM b"""))
def m13_assessed(spark, sf_dir):
    """What follows from a classifier's scores for all rows: set back near hot spots, clamped, forced by size, states."""
    d = detections(spark, sf_dir).withColumn("dist", joins.hotspot_distances(None, SPOTS)).withColumn("score", F.when(F.col("cid") % 13 != 0, F.col("score") * 1.25 - 0.1))
    out = classifier.assessed(d, scoring.deemphasis(F.col("dist"), RADII, ALPHAS), F.col("n_groups"), 15, 0.4, 0.5, 0.9)
    return out.select("cid", "forced", F.round("score", 6).alias("score"), "triage", "validation")


@query(with_members(f""", {_DET}, sp AS (SELECT x.cid, median({hav('x.lat', 'x.lon', 'y.lat', 'y.lon')} / abs(x.t - y.t)) AS speed FROM m x JOIN m y ON x.cid = y.cid AND x.group_id < y.group_id WHERE x.t <> y.t GROUP BY x.cid),
    mn AS (SELECT cid, sum(energy * lon) / sum(energy) AS mx, sum(energy * lat) / sum(energy) AS my FROM m GROUP BY cid), co AS (SELECT cid, sum(energy * pow(lon - mx, 2)) / sum(energy) AS a, sum(energy * (lon - mx) * (lat - my)) / sum(energy) AS b, sum(energy * pow(lat - my, 2)) / sum(energy) AS c FROM m JOIN mn USING (cid) GROUP BY cid),
    li AS (SELECT cid, (a + c + sqrt(pow(a - c, 2) + 4 * b * b)) / 2 AS hi, greatest(0.0, (a + c - sqrt(pow(a - c, 2) + 4 * b * b)) / 2) AS lo FROM co),
    ds AS (SELECT cid, {hav('max(lat)', 'max(lon)', 'min(lat)', 'min(lon)')} AS distance, min(epoch_us(time)) AS first_us, arg_min(lon, i) AS first_lon FROM m GROUP BY cid),
    nb AS (SELECT d.cid, count(g.group_id) AS n_near FROM d LEFT JOIN (SELECT g.*, label.cid AS own FROM g LEFT JOIN label USING (group_id)) g ON g.satellite = d.satellite AND abs(epoch_us(g.time) / 1e6 - d.t0) <= 7200 AND {hav('d.lat', 'd.lon', 'g.lat', 'g.lon')} <= 500 AND NOT (abs(epoch_us(g.time) / 1e6 - d.t0) <= 600 AND {hav('d.lat', 'd.lon', 'g.lat', 'g.lon')} <= 30) AND coalesce(g.own, -1) <> d.cid GROUP BY d.cid)
    SELECT ds.cid, round(distance, 4) AS distance, n_near, round(CASE WHEN hi > 1e-15 THEN 1 - sqrt(lo) / sqrt(hi) ELSE 0 END, 4) AS linearity, round(speed, 8) AS speed, CAST(round(first_us / 1000000.0 + first_lon * 240.0) AS BIGINT) AS local_s FROM ds JOIN nb USING (cid) JOIN li USING (cid) LEFT JOIN sp USING (cid)"""))
def m28_annotations(spark, sf_dir):
    members = written(clusters(spark, sf_dir, CLOSENESS_S, least=1), "members")
    out = features.annotated(members, LEAST_GROUPS, pe.load_groups(spark, sf_dir), 500.0, 30.0, 600.0, 7200.0)
    return out.select("cid", F.round("distance", 4).alias("distance"), "n_near", F.round("linearity", 4).alias("linearity"), F.round("speed", 8).alias("speed"), F.round(F.unix_micros("local_time") / 1e6).cast("long").alias("local_s"))

