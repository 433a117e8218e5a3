"""Queries of profiles of detections, of stereo heights and of layouts of sources, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.functions.geo import to_ecef
from emberline.operators import features, joins, linkage, profiles, scoring, stereo
from emberline.sources import point_events as pe
from emberline.sources.scratch import written

from .cluster_queries import _CURVE, _DET, clusters, detections, matched, scored, truth
from .common import GROUPS, LEAST_GROUPS, hav, query, with_groups, with_members
from .scalar_queries import SPOTS


def with_det(body: str) -> str:
    return with_members(f", {_DET} {body}")


BOXES = [
    profiles.Box(-30.0, 20.0, -76.0, -70.0, "2024-01-05", "2024-01-20 12:00:00"),
    profiles.Box(-50.0, 40.0, -138.0, -133.0, "2024-01-01", "2024-01-28", streak_km=150.0),
]
_ALONG = "greatest(0.0, least(1.0, ((lon + 138) * 5.0 + (lat + 50) * 90.0) / (25.0 + 8100.0)))"
_STRIP = hav("lat", "lon", f"(-50.0 + 90.0 * {_ALONG})", f"(-138.0 + 5.0 * {_ALONG})")


def us(stamp: str) -> str:
    return f"epoch_us(TIMESTAMP '{stamp}') / 1e6"


@query(with_det(f"SELECT cid FROM d WHERE (lat BETWEEN -30 AND 20 AND lon BETWEEN -76 AND -70 AND t0 BETWEEN {us('2024-01-05')} AND {us('2024-01-20 12:00:00')}) OR ({_STRIP} <= 150 AND t0 BETWEEN {us('2024-01-01')} AND {us('2024-01-28')})"))
def p04_detection_boxes(spark, sf_dir):
    return profiles.in_boxes(detections(spark, sf_dir), BOXES).select("cid")


@query(with_det(f"SELECT cid, n_groups FROM d WHERE t0 BETWEEN {us('2024-01-07')} AND {us('2024-01-15')}"))
def p08_date_filter(spark, sf_dir):
    return profiles.between_dates(detections(spark, sf_dir), "2024-01-07", "2024-01-15").select("cid", "n_groups")


@query(with_det("SELECT cid FROM (SELECT cid, CASE WHEN score < 0.1 THEN NULL ELSE t0 END AS t0, CASE WHEN score > 0.9 THEN NULL ELSE n_groups END AS n_groups, CASE WHEN n_groups > 20 THEN NULL ELSE n_groups - 5 END AS k FROM d) WHERE t0 IS NOT NULL AND n_groups IS NOT NULL AND k > 0"))
def p10_valid_profiles(spark, sf_dir):
    d = detections(spark, sf_dir)
    opinions = F.when(F.col("n_groups") <= 20, F.col("n_groups") - LEAST_GROUPS)
    p = d.select("cid", F.when(F.col("score") >= 0.1, F.col("event_time")).alias("event_time"), F.when(F.col("score") <= 0.9, F.col("n_groups")).alias("n_groups"), opinions.alias("n_opinions"))
    return profiles.valid_profiles(p).select("cid")


@query(with_det("SELECT cid, score FROM d WHERE score BETWEEN 0.4 AND 0.9"))
def p11_least_score(spark, sf_dir):
    d = detections(spark, sf_dir).withColumn("belief", F.when(F.col("score") <= 0.9, F.col("score")))
    return profiles.at_least(d, "belief", 0.4).select("cid", "score")


_GRID = """c AS (SELECT *, 6378.137 AS a, 6356.752314245 AS b, radians(la) AS p, radians(lo - lon0) AS dl, atan(pow(6356.752314245 / 6378.137, 2) * tan(radians(la))) AS cc FROM k),
    r AS (SELECT *, b / sqrt(1 - (1 - pow(b / a, 2)) * pow(cos(cc), 2)) AS rc FROM c), v AS (SELECT *, 42164.0 - rc * cos(cc) * cos(dl) AS sx, -rc * cos(cc) * sin(dl) AS sy, rc * sin(cc) AS sz FROM r)"""


@query(f"""WITH {GROUPS}, w AS (SELECT group_id, scene, lat, lon, lon0, x0, lat + 5 <= 81.3282 AND lat - 5 >= -81.3282 AND abs(lat) <= 66.56 AND CASE scene WHEN 'east' THEN lon - 5 >= -156.2995 AND lon - 5 <= 6.2995 AND lon + 5 >= -156.2995 AND lon + 5 <= 6.2995 AND lon BETWEEN -141.56 AND -8.44
    ELSE (lon - 5 >= 141.7005 OR lon - 5 <= -55.7005) AND (lon + 5 >= 141.7005 OR lon + 5 <= -55.7005) AND (lon >= 156.44 OR lon <= -70.44) END AS disk FROM g, (VALUES ('east', -75.0, -0.101346), ('west', -137.0, -0.069986)) s(scene, lon0, x0)),
    k AS (SELECT group_id, scene, disk, lon0, x0, lat + i * 5 AS la, lon + j * 5 AS lo FROM w, (VALUES (-1), (1)) a(i), (VALUES (-1), (1)) b(j)), {_GRID}
    SELECT scene, disk, region, count(*) AS n FROM (SELECT group_id, scene, disk, disk AND bool_and((asin(-sy / sqrt(sx * sx + sy * sy + sz * sz)) - x0) / 2.8e-05 BETWEEN 0 AND 5000 AND (0.128226 - atan2(sz, sx)) / 2.8e-05 BETWEEN 0 AND 3000) AS region FROM v GROUP BY group_id, scene, disk) GROUP BY ALL""")
def p12_scenes(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    rows = None
    for scene in (profiles.EAST, profiles.WEST):
        disk, region = profiles.in_scene(F.col("lat"), F.col("lon"), scene)
        one = g.select(F.lit(scene.satellite).alias("scene"), disk.alias("disk"), region.alias("region"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("scene", "disk", "region").agg(F.count("*").alias("n"))


@query(with_groups("SELECT dataset_file FROM (SELECT dataset_file, min(time) AS s, max(time) AS e FROM g GROUP BY 1) WHERE s >= TIMESTAMP '2024-01-03 00:01:00' - INTERVAL 50 SECOND AND e <= TIMESTAMP '2024-01-20 23:50:00' + INTERVAL 50 SECOND"))
def p13_day_window(spark, sf_dir):
    return profiles.day_window(pe.file_table(pe.load_groups(spark, sf_dir)), "2024-01-03 00:01:00", "2024-01-20 23:50:00").select("dataset_file")


_ALT = "alt AS (SELECT cid, median(energy % 900 / 10.0) AS a1, median(energy % 700 / 9.0) AS a2 FROM m GROUP BY cid)"


def _heights(spark, sf_dir):
    m = clusters(spark, sf_dir)
    return m.groupBy("cid").agg(F.median(F.col("energy") % 900 / 10.0).alias("a1"), F.median(F.col("energy") % 700 / 9.0).alias("a2"))


@query(with_members(f", {_ALT} SELECT cid, a1 < 40 AND a2 < 40 AS low, (a1 < 40 AND a2 < 40) OR (a1 > 50 AND a2 > 50) AS outside FROM alt"))
def p14_height_gate(spark, sf_dir):
    a, b = F.col("a1"), F.col("a2")
    return _heights(spark, sf_dir).select("cid", stereo.outside_limits(a, b, 40.0).alias("low"), stereo.outside_limits(a, b, 40.0, 50.0).alias("outside"))


@query(with_members(f", {_ALT} SELECT cid FROM alt WHERE a1 >= 45 OR a2 >= 45"))
def p15_report_gate(spark, sf_dir):
    return _heights(spark, sf_dir).where(stereo.worth_a_report(F.col("a1"), F.col("a2"), 45.0)).select("cid")


@query(with_groups("SELECT group_id FROM g WHERE floor((lon + 76) / 0.5) >= 0 AND floor((lon + 76) / 0.5) < 8 AND floor((lat + 20) / 0.5) >= 0 AND floor((lat + 20) / 0.5) < 80"))
def p16_in_frame(spark, sf_dir):
    x, y = F.floor((F.col("lon") + 76) / 0.5), F.floor((F.col("lat") + 20) / 0.5)
    return pe.load_groups(spark, sf_dir).where(profiles.in_frame(x, y, 8, 80)).select("group_id")


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def j09_one_to_one(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    ids = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return profiles.one_to_one(ids, o, "o_orderkey")


@query(with_det("SELECT cid, CASE WHEN n_groups >= 8 THEN 1 - score END AS score FROM d"))
def j10_scores_written_back(spark, sf_dir):
    d = written(detections(spark, sf_dir), "detections")
    scores = d.where("n_groups >= 8").select("cid", (1 - F.col("score")).alias("score"))
    return profiles.with_scores(d.select("cid"), scores, "cid")


_WORD = "CASE idx % 5 WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 0.75 WHEN 3 THEN 0.95 ELSE 0.9 END"


@query(with_det(f"SELECT cid, CAST(coalesce({_WORD.replace('idx', 'u.idx')}, 0.0) AS DOUBLE) AS belief FROM (SELECT cid, truth_idx FROM match) x LEFT JOIN truth u ON u.idx = x.truth_idx WHERE u.idx IS NOT NULL UNION ALL SELECT cid, CAST(0.0 AS DOUBLE) FROM match WHERE truth_idx < 0"))
def j13_belief_across_satellites(spark, sf_dir):
    words = F.element_at(F.array(*[F.lit(w) for w in ("rejected", "low", "medium", "high", "auto")]), (F.col("idx") % 5 + 1).cast("int"))
    d, t = written(detections(spark, sf_dir), "detections"), truth(spark, sf_dir)
    matches = None
    for s in pe.satellites("all"):
        one = joins.truth_match(d.where(F.col("satellite") == s), t.where(F.col("satellite") == s))
        matches = one if matches is None else matches.unionByName(one)
    return profiles.belief_of_truth(matches, t, scoring.human_score(words))


@query(with_members("SELECT cid, m.group_id, g.quality, g.event_type FROM m JOIN g USING (dataset_file, group_id)"))
def j14_members_again(spark, sf_dir):
    return profiles.members_of(linkage.by_time(clusters(spark, sf_dir)), pe.load_groups(spark, sf_dir)).select("cid", "group_id", "quality", "event_type")


@query(f"""WITH RECURSIVE {GROUPS}, k AS (SELECT g.*, epoch_us(time) / 1e6 / 1800.0 AS x, {hav('f.la', 'f.lo', 'lat', 'lon')} / 14.0 AS y FROM g JOIN (SELECT satellite, arg_min(lat, (time, group_id)) AS la, arg_min(lon, (time, group_id)) AS lo FROM g WHERE quality = 0 AND energy > 0 GROUP BY 1) f USING (satellite) WHERE quality = 0 AND energy > 0),
    e AS (SELECT a.group_id AS u, b.group_id AS v FROM (SELECT *, CAST(floor(x / 2) AS BIGINT) AS c FROM k) a JOIN (SELECT *, unnest([CAST(floor(x / 2) AS BIGINT) - 1, CAST(floor(x / 2) AS BIGINT), CAST(floor(x / 2) AS BIGINT) + 1]) AS c FROM k) b ON a.satellite = b.satellite AND a.c = b.c WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 2),
    r AS (SELECT group_id AS a, group_id AS z FROM k UNION SELECT r.a, e.v FROM r JOIN e ON r.z = e.u) SELECT a AS group_id, min(z) AS cid, count(*) AS n FROM r GROUP BY a""")
def d02_radial_linkage(spark, sf_dir):
    return linkage.radial_linkage(pe.scan_groups(pe.load_groups(spark, sf_dir)), 14.0, 1800.0).select("group_id", "cid", "n")


_METHOD = "CASE WHEN n_groups < 8 THEN 'forest' WHEN n_groups < 12 THEN 'network' ELSE 'deep network' END"


@query(with_det(f"SELECT truth_idx, n, round(score, 9) AS score, method, n_members FROM (SELECT truth_idx, count(*) AS n, list_reduce(list(score ORDER BY cid), lambda a, b: (a + b) / 2) AS score, list_reduce(list({_METHOD} ORDER BY cid), lambda a, b: CASE WHEN contains(a, b) THEN a ELSE 'Combined: ' || a || ' + ' || b END) AS method, CAST(sum(n_groups) AS BIGINT) AS n_members FROM match JOIN d USING (cid) WHERE truth_idx >= 0 GROUP BY truth_idx)"))
def d09_merged_detections(spark, sf_dir):
    members = written(clusters(spark, sf_dir), "members")
    d = features.basic(members).select("cid", "n_groups", "satellite", "lat", "lon", "mid_from", "mid_to").join(linkage.by_time(members).select("cid", "members"), "cid")
    d = written(d.withColumns({"score": (F.col("cid") * 7919 % 1000) / 1000.0, "method": F.when(F.col("n_groups") < 8, "forest").when(F.col("n_groups") < 12, "network").otherwise("deep network")}), "detections")
    rows = d.join(joins.truth_match(d, truth(spark, sf_dir)).where("truth_idx >= 0"), "cid")
    out = profiles.merged_detections(rows, "truth_idx", "cid")
    return out.select("truth_idx", F.col("n").cast("long").alias("n"), F.round("score", 9).alias("score"), "method", F.size("members").cast("long").alias("n_members"))


_D1, _D2 = hav("d.lat", "d.lon", "1.0", "-75.0"), hav("d.lat", "d.lon", "18.0", "-137.0")


@query(with_det(f"""SELECT truth_idx, round(list_reduce(list(t0 ORDER BY cid), lambda a, b: (a + b) / 2), 3) AS t, round(list_reduce(list(d.lat ORDER BY cid), lambda a, b: (a + b) / 2), 6) AS lat, round(list_reduce(list(d.lon ORDER BY cid), lambda a, b: (a + b) / 2), 6) AS lon, CAST(sum(n_groups) AS BIGINT) AS n_groups,
    min(ma) AS mid_from, max(mb) AS mid_to, round(min({_D1}), 4) AS dist_1, round(min({_D2}), 4) AS dist_2 FROM match JOIN d USING (cid) WHERE truth_idx >= 0 GROUP BY truth_idx"""))
def a20_combined_features(spark, sf_dir):
    d, m = matched(spark, sf_dir)
    rows = d.withColumn("dist", joins.hotspot_distances(None, SPOTS)).join(m.where("truth_idx >= 0"), "cid")
    f = profiles.combined_features(rows, "truth_idx", "cid")
    return f.select("truth_idx", F.round(linkage.seconds(F.col("event_time")), 3).alias("t"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "n_groups", linkage.seconds(F.col("mid_from")).alias("mid_from"), linkage.seconds(F.col("mid_to")).alias("mid_to"), F.round(F.col("dist")[0], 4).alias("dist_1"), F.round(F.col("dist")[1], 4).alias("dist_2"))


#: Two satellites that see the points of the stand-in from either side, at a known height.
SAT_EAST, SAT_WEST = -75.2, -137.2


def seen_twice(groups):
    """Points between the satellites, a known height above the ellipsoid of navigated positions, as both see them."""
    h = (F.col("energy") % 60 + 20).cast("double")
    lat, lon = F.col("lat") / 2, F.when(F.col("lon") < -100, F.col("lon") + 30).otherwise(F.col("lon") - 30)
    rows = groups.select("group_id", "time", h.alias("height"), lat.alias("lat"), lon.alias("lon"))
    (a1, o1), (a2, o2) = (stereo.seen_from(F.col("lat"), F.col("lon"), F.col("height"), s) for s in (SAT_EAST, SAT_WEST))
    return rows.select("group_id", "time", a1.alias("lat1"), o1.alias("lon1"), a2.alias("lat2"), o2.alias("lon2"))


_TWICE = "p AS (SELECT *, CAST(energy % 60 + 20 AS DOUBLE) AS h, lat / 2 AS la, CASE WHEN lon < -100 THEN lon + 30 ELSE lon - 30 END AS lo FROM g)"


@query(f"WITH {GROUPS}, {_TWICE} SELECT group_id, round(h, 2) AS alt, round(la, 4) AS lat, round(lo, 4) AS lon, true AS met FROM p")
def c03_c04_heights(spark, sf_dir):
    a = stereo.altitudes(seen_twice(pe.load_groups(spark, sf_dir)), SAT_EAST, SAT_WEST)
    met = (F.col("residual") < 0.001) & (F.abs(F.col("place_lat1") - F.col("place_lat2")) < 0.0001)
    return a.select("group_id", F.round("alt", 2).alias("alt"), F.round("place_lat1", 4).alias("lat"), F.round("place_lon1", 4).alias("lon"), met.alias("met"))


_XYZ = "z AS (SELECT m.cid, m.group_id, m.t, CAST(m.energy % 60 + 20 AS DOUBLE) AS h, (n + m.energy % 60 + 20) * cos(p) * cos(q) AS x, (n + m.energy % 60 + 20) * cos(p) * sin(q) AS y, (n * (1 - e2) + m.energy % 60 + 20) * sin(p) AS z, lat, lon FROM (SELECT m.* EXCLUDE (n), radians(lat) AS p, radians(lon) AS q, 1 - pow(6356.752314245 / 6378.137, 2) AS e2, 6378.137 / sqrt(1 - (1 - pow(6356.752314245 / 6378.137, 2)) * pow(sin(radians(lat)), 2)) AS n FROM m) m)"


def _in_space(spark, sf_dir):
    m = clusters(spark, sf_dir)
    h = (F.col("energy") % 60 + 20).cast("double")
    x, y, z = to_ecef(F.col("lat"), F.col("lon"), h)
    return m.select("cid", "group_id", "lat", "lon", linkage.seconds(F.col("time")).alias("t"), x.alias("x"), y.alias("y"), z.alias("z"), h.alias("alt"), (h / 10).alias("residual"))


@query(with_members(f", {_XYZ} SELECT cid, round(sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2) + pow(max(z) - min(z), 2)), 4) AS max_dist, round({hav('max(lat)', 'max(lon)', 'min(lat)', 'min(lon)')}, 4) AS max_ground_track FROM z GROUP BY cid"))
def a09_extent(spark, sf_dir):
    return stereo.extent(_in_space(spark, sf_dir)).select("cid", F.round("max_dist", 4).alias("max_dist"), F.round("max_ground_track", 4).alias("max_ground_track"))


@query(with_members(f", {_XYZ} SELECT cid, alt, round(alt / 10, 6) AS residual, round(speed, 6) AS speed FROM (SELECT cid, median(h) AS alt FROM z GROUP BY cid) LEFT JOIN (SELECT a.cid, median(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) / abs(a.t - b.t)) AS speed FROM z a JOIN z b ON a.cid = b.cid AND a.group_id < b.group_id WHERE a.t <> b.t GROUP BY a.cid) USING (cid)"))
def a12_stereo_medians(spark, sf_dir):
    m = stereo.medians(_in_space(spark, sf_dir))
    return m.select("cid", "alt", F.round("residual", 6).alias("residual"), F.round("speed", 6).alias("speed"))


@query(with_members(f", dm AS (SELECT cid, any_value(satellite) AS satellite, median(lat) AS la, median(lon) AS lo, median(t) AS t FROM m GROUP BY cid) SELECT cid, count(*) AS n FROM dm JOIN g USING (satellite) WHERE abs(epoch_us(time) / 1e6 - t) <= 1800 AND {hav('la', 'lo', 'lat', 'lon')} <= 500 GROUP BY cid"))
def c05_surroundings(spark, sf_dir):
    m = clusters(spark, sf_dir)
    d = m.groupBy("cid").agg(F.first("satellite").alias("satellite"), F.median("lat").alias("lat"), F.median("lon").alias("lon"), F.median(linkage.seconds(F.col("time"))).alias("t0"))
    return stereo.surroundings(d, pe.load_groups(spark, sf_dir), 500.0, 1800.0).groupBy("cid").agg(F.count("*").alias("n"))


@query(with_groups(f"SELECT group_id, round(CASE WHEN lat < 0 THEN pi() * 6371.0 ELSE {hav('lat', 'lon', 'lat / 2', 'lon + 3')} END, 4) AS glint FROM g"))
def c08_glint_distance(spark, sf_dir):
    shown = lambda c: F.when(F.col("lat") >= 0, c)
    d = profiles.glint_distance(F.col("lat"), F.col("lon"), shown(F.col("lat") / 2), shown(F.col("lon") + 3))
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(d, 4).alias("glint"))


@query(with_det("SELECT count(*) AS n_tot, count(*) FILTER (score >= 0.5) AS n_tot_accepted, count(*) FILTER (score < 0.5) AS n_tot_rejected, CAST(sum(n_groups) AS BIGINT) AS n_tot_groups FROM d"))
def a19_totals(spark, sf_dir):
    return detections(spark, sf_dir).agg(F.count("*").alias("n_tot"), F.count_if(F.col("score") >= 0.5).alias("n_tot_accepted"), F.count_if(F.col("score") < 0.5).alias("n_tot_rejected"), F.sum("n_groups").alias("n_tot_groups"))


_FOLDS = "s AS (SELECT cid % 4 AS fold, score, truth_idx >= 0 AS is_true FROM d JOIN match USING (cid)), q AS (SELECT fold, score, sum(t) OVER w AS tp, sum(n) OVER w AS found, sum(t) OVER (PARTITION BY fold) AS possible FROM (SELECT fold, score, count(*) FILTER (is_true) AS t, count(*) AS n FROM s GROUP BY ALL) WINDOW w AS (PARTITION BY fold ORDER BY score DESC)), c AS (SELECT fold, score, tp / found AS p, tp / nullif(possible, 0) AS r FROM q)"


@query(with_det(f""", {_FOLDS}, b AS (SELECT p, r, greatest(0, coalesce(CAST(floor(round((score + lag(score) OVER w) / 2 * 200, 6)) AS BIGINT) + 1, 0)) AS lo, least(199, coalesce(CAST(floor(round((score + lead(score) OVER w) / 2 * 200, 6)) AS BIGINT), 199)) AS hi FROM c WINDOW w AS (PARTITION BY fold ORDER BY score)),
    x AS (SELECT p, r, unnest(generate_series(lo, hi)) AS step FROM b WHERE lo <= hi) SELECT step, round(avg(p), 6) AS precision_mean, round(quantile_cont(p, 0.05), 6) AS precision_low, round(quantile_cont(p, 0.95), 6) AS precision_high, round(avg(r), 6) AS recall_mean, round(quantile_cont(r, 0.05), 6) AS recall_low, round(quantile_cont(r, 0.95), 6) AS recall_high FROM x GROUP BY step"""))
def a21_precision_band(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("fold", F.col("cid") % 4)
    out = profiles.precision_band(scoring.curves_by(s, "fold"), 200)
    return out.select("step", *[F.round(c, 6).alias(c) for c in out.columns if c != "step"])


@query("SELECT count(*) FILTER (v = 'TP') AS tp, count(*) FILTER (v = 'FP') AS fp, count(*) FILTER (v = 'UNC') AS unc, count(*) FILTER (v IS NULL OR v NOT IN ('TP', 'FP', 'UNC')) AS errors FROM (SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'TP' WHEN quality = 0 AND toxic = 0 THEN 'FP' WHEN quality = 1 THEN 'UNC' WHEN doc_id % 2 = 0 THEN 'unsure' END AS v FROM labels)")
def a26_verdict_counts(spark, sf_dir):
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    v = F.when(q & ~t, "TP").when(~q & ~t, "FP").when(q, "UNC").when(F.col("doc_id") % 2 == 0, "unsure")
    return profiles.verdict_counts(spark.read.parquet(f"{sf_dir}/labels.parquet").select(v.alias("verdict")))


@query(with_members(f"SELECT cid, round((max(t) - min(t)) / 60, 4) AS minutes, round(arg_min(lat, i), 6) AS start_lat, round(arg_min(lon, i), 6) AS start_lon, round(arg_max(lat, i), 6) AS end_lat, round(arg_max(lon, i), 6) AS end_lon, round(coalesce(sum(km), 0), 4) AS km FROM (SELECT *, {hav('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} AS km FROM m WINDOW w AS (PARTITION BY cid ORDER BY i)) GROUP BY cid"))
def w13_streak_statistics(spark, sf_dir):
    s = profiles.streak_statistics(clusters(spark, sf_dir), "cid")
    return s.withColumns({c: F.round(c, 4 if c in ("minutes", "km") else 6) for c in s.columns if c != "cid"})


@query()
def o04_sample(spark, sf_dir):
    return profiles.sample_of(detections(spark, sf_dir).select("cid", "n_groups"), 25, "cid", seed=3)


@query("SELECT day, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION ALL SELECT CAST(ts AS DATE) FROM events) GROUP BY day")
def o09_concatenated(spark, sf_dir):
    o, li, e = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem", "events"))
    days = [o.select(F.to_date("o_orderdate").alias("day")), li.select(F.to_date("l_shipdate").alias("day")), e.select(F.to_date("ts").alias("day"))]
    return days[0].unionByName(days[1]).unionByName(days[2]).groupBy("day").agg(F.count("*").alias("n"))


@query(with_det("SELECT cid, CAST(round_even(score * 8, 0) + 1 AS INTEGER) AS slider, round((round_even(score * 8, 0) + 1 - 1) / 8.0, 6) AS belief FROM d"))
def f16_sliders(spark, sf_dir):
    s = detections(spark, sf_dir).select("cid", profiles.slider_of_belief(F.col("score"), 1, 9).alias("slider"))
    return s.select("cid", "slider", F.round(profiles.belief_of_slider(F.col("slider"), 1, 9), 6).alias("belief"))


@query(with_groups("SELECT dataset_file, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, round(min(lat) - 2.5, 6) AS lat_lo, round(max(lat) + 2.5, 6) AS lat_hi, round(min(lon) - 2.5, 6) AS lon_lo, round(max(lon) + 2.5, 6) AS lon_hi FROM (SELECT dataset_file, CASE WHEN quality = 0 THEN lat END AS lat, CASE WHEN quality <> 5 THEN lon END AS lon FROM g) GROUP BY 1"))
def f17_view_boxes(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    holes = g.select("dataset_file", F.when(F.col("quality") == 0, F.col("lat")).otherwise(float("nan")).alias("lat"), F.when(F.col("quality") != 5, F.col("lon")).alias("lon"))
    v = profiles.view_box(holes, "dataset_file", 2.5)
    return v.select("dataset_file", *[F.round(c, 6).alias(c) for c in v.columns if c != "dataset_file"])


@query("SELECT i AS part_no, part, name FROM (SELECT DISTINCT split_part(url, '?', 1) AS name FROM pages), (VALUES (0, '1'), (1, 'a'), (2, '-2')) p(i, part) WHERE contains(split_part(name, '/', -1), part)")
def f18_names_in_order(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.split_part("url", F.lit("?"), F.lit(1)).alias("name")).distinct()
    return profiles.in_order_of_parts(names, ["1", "a", "-2"])


@query(with_det("SELECT cid, true AS is_detection, score AS belief, 'forest' AS method FROM d WHERE score >= 0.5 UNION ALL SELECT cid, false, score, 'forest' FROM d WHERE score < 0.5"))
def m14_profiles(spark, sf_dir):
    d = written(detections(spark, sf_dir).withColumns({"triage_score": F.col("score"), "triage_method": F.lit("forest")}), "detections")
    return profiles.profiles(d.where("score >= 0.5"), d.where("score < 0.5"), "triage")


@query(with_det("SELECT cid, v AS validation_score, CASE WHEN forced AND (v IS NULL OR v < 0.8) THEN 'candidate' WHEN v IS NULL THEN 'N/A' WHEN v < 0.3 THEN 'rejected' WHEN v < 0.8 THEN 'candidate' ELSE 'accepted' END AS state FROM (SELECT cid, CASE WHEN n_groups >= 8 THEN 1 - score END AS v, score >= 0.9 OR n_groups >= 20 AS forced FROM d)"))
def m19_evaluated(spark, sf_dir):
    d = written(detections(spark, sf_dir), "detections")
    scores = d.where("n_groups >= 8").select("cid", (1 - F.col("score")).alias("score"))
    return profiles.evaluated(d, scores, 0.3, 0.8, 0.9, 20).select("cid", "validation_score", "state")


@query(with_det("SELECT cid, CASE WHEN truth_idx >= 0 THEN 'detection' ELSE 'rejection' END AS kind FROM d JOIN match USING (cid) WHERE CAST(make_timestamp(CAST(t0 * 1000000 AS BIGINT)) AS DATE) IN (SELECT CAST(time AS DATE) FROM g WHERE event_type = 'purchase')"))
def m21_truth_mode(spark, sf_dir):
    d, m = matched(spark, sf_dir)
    t = pe.load_groups(spark, sf_dir).where("event_type = 'purchase'").select("time")
    return profiles.truth_mode(d, m, t, 1.0).select("cid", "kind")


@query(with_members("SELECT cid, count(*) AS n_groups, CAST(sum(energy) AS BIGINT) AS energy FROM m GROUP BY cid HAVING count(*) >= 20"))
def m24_large_clusters(spark, sf_dir):
    return clusters(spark, sf_dir, least=20).groupBy("cid").agg(F.count("*").alias("n_groups"), F.sum("energy").alias("energy"))


@query("SELECT s AS sample, CASE s % 4 WHEN 1 THEN y WHEN 2 THEN 15 - fx WHEN 3 THEN 15 - y ELSE fx END AS x, CASE s % 4 WHEN 1 THEN 15 - fx WHEN 2 THEN 15 - y WHEN 3 THEN fx ELSE y END AS y, n FROM (SELECT s, CASE WHEN s % 8 >= 4 THEN 15 - x ELSE x END AS fx, y, n FROM (SELECT CAST(l_suppkey AS BIGINT) AS s, CAST(l_partkey % 16 AS BIGINT) AS x, CAST(l_orderkey % 16 AS BIGINT) AS y, count(*) AS n FROM lineitem GROUP BY ALL))")
def m20_turned_images(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    px = li.groupBy(F.col("l_suppkey").cast("long").alias("sample"), (F.col("l_partkey") % 16).cast("long").alias("x"), (F.col("l_orderkey") % 16).cast("long").alias("y")).agg(F.count("*").alias("n"))
    px = px.withColumns({"turns": F.col("sample") % 4, "flip": F.col("sample") % 8 >= 4})
    return profiles.turned(px, 16).select("sample", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "n")


@query(with_det("SELECT cid, image, name FROM (SELECT cid, unnest(['band', 'curve']) AS image, unnest([cid || '_b.png', cid || '_c.png']) AS name FROM d WHERE score >= 0.2 AND n_groups % 3 <> 0 AND n_groups < 15)"))
def m27_usable_images(spark, sf_dir):
    name = lambda s: F.concat(F.col("cid").cast("string"), F.lit(s))
    rows = detections(spark, sf_dir).select("cid", (F.col("score") >= 0.2).alias("cutout"), F.lit(32).alias("height"), F.when(F.col("n_groups") % 3 == 0, 31).otherwise(32).alias("width"), name("_b.png").alias("band"), F.when(F.col("n_groups") < 15, name("_c.png")).alias("curve"))
    return profiles.usable_images(rows, ["band", "curve"])


@query(with_groups("SELECT group_id AS event_id, group_id - group_id % 5 AS parent_group_id, quality AS data_quality, energy FROM g WHERE energy > 0"))
def s02_event_scan(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).where("energy > 0")
    return g.select(F.col("group_id").alias("event_id"), (F.col("group_id") - F.col("group_id") % 5).alias("parent_group_id"), F.col("quality").alias("data_quality"), "energy")


@query("SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'hours' WHEN 1 THEN 'days' ELSE 'bundles' END AS layout, CAST(ts AS DATE) AS day FROM events")
def s08_layouts(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    f = lambda p: F.date_format("ts", p)
    path = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("/d/G16/"), f("yyyy/DDD/HH/"), F.lit("a.nc"))).when(F.col("user_id") % 3 == 1, F.concat(F.lit("/d/G17/"), f("yyyy/MMdd/"), F.lit("a.nc")))
    path = path.otherwise(F.concat(F.lit("/d/G18/"), f("yyyy"), F.lit("/OR_GLM-L2-LCFA_G18_s"), f("yyyyMMdd"), F.lit(".nc.tgz")))
    layout, day = pe.layout_of(path)
    return e.select("event_id", layout.alias("layout"), day.alias("day"))


@query(with_groups("SELECT CAST(floor((lon + 180) / 0.01) AS BIGINT) // 50 AS x, CAST(floor((lat + 90) / 0.01) AS BIGINT) // 50 AS y, quality AS band, round(avg(energy), 6) AS value FROM g GROUP BY ALL"))
def s12_bands_on_one_grid(spark, sf_dir):
    px = pe.load_groups(spark, sf_dir).select(F.floor((F.col("lon") + 180) / 0.01).alias("x"), F.floor((F.col("lat") + 90) / 0.01).alias("y"), F.col("quality").alias("band"), F.col("energy").alias("value"))
    return pe.area_averaged(px, 50).withColumn("value", F.round("value", 6))
