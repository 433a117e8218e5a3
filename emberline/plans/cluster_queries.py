"""Queries of clusters and their features, and the flagship detection query."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.functions.membership import membership
from emberline.operators import features, joins, linkage, profiles, scoring
from emberline.sources import point_events as pe
from emberline.sources.scratch import written

from .common import CLOSENESS_KM, CLOSENESS_S, GROUPS, LEAST_GROUPS, hav, query, with_groups, with_members
from .scalar_queries import ALPHAS, RADII, SPOTS


def clusters(spark, sf_dir, closeness_s=CLOSENESS_S, least=LEAST_GROUPS):
    return linkage.single_linkage(pe.scan_groups(pe.load_groups(spark, sf_dir)), CLOSENESS_KM, closeness_s, least)


@query(with_members("SELECT group_id, cid, CAST(n AS BIGINT) AS n FROM m"))
def d01_linkage(spark, sf_dir):
    return clusters(spark, sf_dir).select("group_id", "cid", "n")


@query(f"WITH {GROUPS}, k AS (SELECT *, epoch_us(time) / 1e6 AS t FROM g WHERE quality = 0 AND energy > 0), s AS (SELECT *, CASE WHEN t - lag(t) OVER w >= 600 OR lag(t) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM k WINDOW w AS (PARTITION BY satellite ORDER BY time, group_id)), r AS (SELECT *, sum(new) OVER (PARTITION BY satellite ORDER BY time, group_id) AS run FROM s) SELECT satellite, CAST(run AS BIGINT) AS run, min(time) AS time, CAST(sum(energy) AS BIGINT) AS energy, count(*) AS n FROM r GROUP BY satellite, run")
def d17_condense(spark, sf_dir):
    return linkage.condensed(pe.scan_groups(pe.load_groups(spark, sf_dir)), "satellite", 600.0)


_A = with_members(f"""SELECT cid, any_value(satellite) AS satellite, count(*) AS n_groups, max(time) FILTER (i = n // 2 + 1) AS event_time, max(time) FILTER (i = n // 4 + 1) AS mid_from,
    max(time) FILTER (i = n - CAST(ceil(n / 4.0) AS BIGINT) + 1) AS mid_to, round(median(lat), 6) AS lat, round(median(lon), 6) AS lon,
    CASE WHEN count(*) < 15 THEN max(energy) ELSE list_sort(list(energy), 'DESC')[3] END AS max_energy, CAST(sum(energy) AS BIGINT) AS total_energy,
    min(time) AS start_time, max(time) AS end_time, round({hav('max(lat)', 'max(lon)', 'min(lat)', 'min(lon)')}, 4) AS ground_distance,
    round(epoch_us(max(time)) / 1e6 - epoch_us(min(time)) / 1e6, 4) AS duration FROM m GROUP BY cid""")


@query(_A)
def a01_a08_basic_features(spark, sf_dir):
    f = features.basic(clusters(spark, sf_dir))
    return f.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6), "ground_distance": F.round("ground_distance", 4), "duration": F.round("duration", 4)})


@query(with_members(""", f AS (SELECT dataset_file, min(time) AS s, max(time) AS e FROM g WHERE quality = 0 AND energy > 0 AND hour(time) BETWEEN 1 AND 22 GROUP BY 1),
    c AS (SELECT cid, CAST(any_value(n) // 2 + 1 AS BIGINT) AS middle, arg_min(dataset_file, i) AS df, max(time) FILTER (i = n // 2 + 1) AS mt, min(time) < max(time) AS moves FROM m GROUP BY cid)
    SELECT cid, middle, true AS moves FROM c JOIN f ON f.dataset_file = c.df WHERE mt BETWEEN s AND e AND moves"""))
def d06_boundary_filter(spark, sf_dir):
    """Files that cover the hours from 1 to 22 of their days: clusters whose middle lies outside go."""
    g = pe.scan_groups(pe.load_groups(spark, sf_dir)).where(F.hour("time").between(1, 22))
    rows = linkage.boundary_filter(linkage.by_time(clusters(spark, sf_dir)), pe.file_table(g).select("dataset_file", "start", "end"))
    return rows.select("cid", (F.floor(F.size("members") / 2) + 1).cast("long").alias("middle"), F.lit(True).alias("moves"))


@query(with_members(f"SELECT x.cid, round(median({hav('x.lat', 'x.lon', 'y.lat', 'y.lon')} / abs(x.t - y.t)), 8) AS speed FROM m x JOIN m y ON x.cid = y.cid AND x.group_id < y.group_id WHERE x.t <> y.t GROUP BY x.cid"))
def a07_average_speed(spark, sf_dir):
    return features.average_speed(clusters(spark, sf_dir)).select("cid", F.round("speed", 8).alias("speed")).where("speed is not null")


@query(with_members("""SELECT cid, round(CASE WHEN hi > 1e-15 THEN 1 - sqrt(lo) / sqrt(hi) ELSE 0 END, 4) AS linearity FROM (SELECT cid, (a + c + sqrt(pow(a - c, 2) + 4 * b * b)) / 2 AS hi, greatest(0.0, (a + c - sqrt(pow(a - c, 2) + 4 * b * b)) / 2) AS lo FROM (
    SELECT cid, sum(energy * pow(lon - mx, 2)) / sum(energy) AS a, sum(energy * (lon - mx) * (lat - my)) / sum(energy) AS b, sum(energy * pow(lat - my, 2)) / sum(energy) AS c FROM m JOIN (SELECT cid, sum(energy * lon) / sum(energy) AS mx, sum(energy * lat) / sum(energy) AS my FROM m GROUP BY cid) USING (cid) GROUP BY cid))"""))
def a10_linearity(spark, sf_dir):
    return features.linearity(clusters(spark, sf_dir)).select("cid", F.round("linearity", 4).alias("linearity"))


@query(with_members("SELECT cid, round(sum(energy * lat) / sum(energy), 6) AS lat, round(sum(energy * lon) / sum(energy), 6) AS lon FROM m GROUP BY cid"))
def a11_weighted_centroid(spark, sf_dir):
    return features.weighted_centroid(clusters(spark, sf_dir)).select("cid", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(with_members("SELECT cid, round(CASE WHEN max(t) = min(t) THEN 0 ELSE (min(t) FILTER (2 * r > s) - min(t)) / (max(t) - min(t)) END, 6) AS energy_ratio FROM (SELECT *, sum(energy) OVER (PARTITION BY cid ORDER BY i) AS r, sum(energy) OVER (PARTITION BY cid) AS s FROM m) GROUP BY cid"))
def w02_energy_ratio(spark, sf_dir):
    return features.energy_ratio(clusters(spark, sf_dir)).select("cid", F.round("energy_ratio", 6).alias("energy_ratio"))


@query(with_members("""SELECT cid, round(coalesce(sqrt(pow(median(rx), 2) + pow(median(ry), 2)), 10000.0), 5) AS linelet FROM (
    SELECT cid, w, CASE WHEN count(*) > 2 AND var_pop(u) > 0 THEN greatest(0.0, count(*) * (var_pop(lon) - pow(covar_pop(lon, u), 2) / var_pop(u))) END AS rx, CASE WHEN count(*) > 2 AND var_pop(u) > 0 THEN greatest(0.0, count(*) * (var_pop(lat) - pow(covar_pop(lat, u), 2) / var_pop(u))) END AS ry
    FROM (SELECT *, (i - 1) // 5 AS w, t - min(t) OVER (PARTITION BY cid) AS u FROM m) WHERE w < greatest(n // 5 - 1, 1) GROUP BY cid, w) GROUP BY cid"""))
def w03_linelets(spark, sf_dir):
    return features.linelets(clusters(spark, sf_dir)).select("cid", F.round("linelet", 5).alias("linelet"))


@query(with_members("""SELECT cid, round(log10(avg(res * pow(1.0 / hi - lo, 2)) + 1), 5) AS splinelet FROM (SELECT *, pow(energy - 4.0 * lead(energy, 1) OVER w + 6.0 * lead(energy, 2) OVER w - 4.0 * lead(energy, 3) OVER w + lead(energy, 4) OVER w, 2) / 70 AS res,
    min(energy) OVER (PARTITION BY cid) AS lo, max(energy) OVER (PARTITION BY cid) AS hi FROM m WINDOW w AS (PARTITION BY cid ORDER BY i)) WHERE i <= greatest(n - 5, 1) GROUP BY cid"""))
def w04_splinelets(spark, sf_dir):
    return features.splinelets(clusters(spark, sf_dir)).select("cid", F.round(F.log10(F.col("splinelet") + 1), 5).alias("splinelet"))


@query(with_members("""SELECT cid, count(*) AS n, count(*) FILTER (filled) AS n_filled FROM (SELECT cid, false AS filled FROM (SELECT DISTINCT cid, t FROM m)
    UNION ALL SELECT cid, true FROM (SELECT cid, unnest(generate_series(0, CAST(ceil((nx - t - 6000) / 600) AS BIGINT) - 1)) FROM (SELECT cid, t, lead(t) OVER (PARTITION BY cid ORDER BY t) AS nx FROM (SELECT DISTINCT cid, t FROM m)) WHERE nx - t > 3000 AND nx - t - 6000 > 0)) GROUP BY cid"""))
def w09_gap_fill(spark, sf_dir):
    return features.filled_gaps(clusters(spark, sf_dir), frame=600.0).groupBy("cid").agg(F.count("*").alias("n"), F.count_if("filled").alias("n_filled"))


@query(with_members("""SELECT cid, round(count(*) FILTER (i < n AND e < thr AND before = 1 AND least <= thr) / CAST(any_value(n) AS DOUBLE), 6) AS chop FROM (
        SELECT *, last_value(side IGNORE NULLS) OVER (PARTITION BY cid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, min(e) OVER (PARTITION BY cid ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS least
        FROM (SELECT *, CASE WHEN e > 1.1 * thr THEN 1 WHEN e < thr THEN 0 END AS side FROM (SELECT cid, i, n, CAST(energy AS DOUBLE) AS e FROM m) JOIN (SELECT cid, CAST(1.482602218505602 AS DOUBLE) * mad(CAST(energy AS DOUBLE)) AS thr FROM m GROUP BY cid) USING (cid)))
    GROUP BY cid"""))
def w01_chop(spark, sf_dir):
    return features.chop(clusters(spark, sf_dir)).select("cid", F.round("chop", 6).alias("chop"))


@query(with_members(f"""SELECT cid, round(coalesce(max(dev) FILTER (off <= 5 * 1.4826 * spread), max(dev)), 6) AS deviation FROM (
        SELECT *, mad(off) OVER (PARTITION BY cid) AS spread FROM (SELECT *, CASE WHEN med = 0 THEN 0 ELSE abs(dev - med) / med END AS off FROM (SELECT *, median(dev) OVER (PARTITION BY cid) AS med FROM (
            SELECT cid, round(CASE WHEN flat THEN {hav("slope * lon + icept", "lon", "lat", "lon")} ELSE {hav("lat", "slope * lat + icept", "lat", "lon")} END, 9) AS dev
            FROM m JOIN (SELECT cid, flat, regr_slope(CASE WHEN flat THEN lat ELSE lon END, CASE WHEN flat THEN lon ELSE lat END) AS slope, regr_intercept(CASE WHEN flat THEN lat ELSE lon END, CASE WHEN flat THEN lon ELSE lat END) AS icept
                FROM m JOIN (SELECT cid, abs(max(lon) FILTER (i = n) - max(lon) FILTER (i = 1)) > abs(max(lat) FILTER (i = n) - max(lat) FILTER (i = 1)) AS flat FROM m GROUP BY cid) USING (cid) GROUP BY cid, flat) USING (cid)))))
    GROUP BY cid"""))
def w05_track_deviation(spark, sf_dir):
    return features.track_deviation(clusters(spark, sf_dir)).select("cid", F.round("deviation", 6).alias("deviation"))


_ID = "CAST(CAST(substr(satellite, 2) AS BIGINT) * 100000000000000 + CAST(strftime(time, '%Y%j%H%M%S') || CAST(CAST(floor((epoch_us(time) % 1000000) / 100000) AS INTEGER) AS VARCHAR) AS BIGINT) AS BIGINT)"


@query(with_members(f"SELECT cid, p * 1000 + row_number() OVER (PARTITION BY p ORDER BY time, cid) AS detection_id FROM (SELECT cid, time, {_ID} AS p FROM m WHERE i = n // 2 + 1)"))
def d11_detection_ids(spark, sf_dir):
    f = features.basic(clusters(spark, sf_dir)).withColumn("time", F.col("event_time"))
    return linkage.detection_ids(f).select("cid", "detection_id")


@query(with_members(f"SELECT cid, p * 1000 + 1 + row_number() OVER (PARTITION BY p ORDER BY time, cid) AS detection_id FROM (SELECT cid, time, {_ID} AS p FROM m WHERE i = n // 2 + 1)"))
def d12_id_collisions(spark, sf_dir):
    f = written(features.basic(clusters(spark, sf_dir)).withColumn("time", F.col("event_time")), "detections")
    taken = linkage.detection_ids(f).select((F.floor(F.col("detection_id") / 1000) * 1000 + 1).alias("detection_id")).distinct()
    return linkage.detection_ids(f, taken).select("cid", "detection_id")


@query(with_members("SELECT cid, ids FROM (SELECT cid, array_to_string(list_sort(list(group_id)), ',') AS ids FROM m GROUP BY cid)"))
def d10_dedup(spark, sf_dir):
    c = written(linkage.by_time(clusters(spark, sf_dir).select("cid", "satellite", "group_id")), "detections")
    twice = c.withColumns({"is_primary": F.lit(True), "ord": F.lit(1)}).unionByName(c.withColumns({"is_primary": F.lit(False), "ord": F.lit(0)}))
    out = linkage.without_duplicates(twice).where("is_primary")
    return out.select("cid", F.concat_ws(",", F.transform(F.array_sort(F.transform("members", lambda m: m["group_id"])), lambda x: x.cast("string"))).alias("ids"))


@query(with_groups("SELECT box, count(*) AS n, CAST(sum(energy) AS BIGINT) AS energy FROM g JOIN (VALUES ('a', 0.0, 2.0, -76.0, -74.0), ('b', -60.0, 60.0, -140.0, -136.5)) b(box, la, lb, oa, ob) ON lat BETWEEN la AND lb AND lon BETWEEN oa AND ob GROUP BY box"))
def d08_box_clusters(spark, sf_dir):
    boxes = spark.createDataFrame([("a", 0.0, 2.0, -76.0, -74.0), ("b", -60.0, 60.0, -140.0, -136.5)], "box string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
    return linkage.merge_by_box(pe.load_groups(spark, sf_dir), boxes).groupBy("box").agg(F.count("*").alias("n"), F.sum("energy").alias("energy"))


_DET = f"""d AS (SELECT cid, any_value(satellite) AS satellite, count(*) AS n_groups, max(t) FILTER (i = n // 2 + 1) AS t0, max(t) FILTER (i = n // 4 + 1) AS ma, max(t) FILTER (i = n - CAST(ceil(n / 4.0) AS BIGINT) + 1) AS mb,
    median(lat) AS lat, median(lon) AS lon, (cid * 7919 % 1000) / 1000.0 AS score FROM m GROUP BY cid),
    truth AS (SELECT group_id AS idx, satellite, lat, lon, epoch_us(time) / 1e6 - 21600 - 0.5 AS lo, epoch_us(time) / 1e6 + 21600 + 0.5 AS hi, event_type, group_id % 3 <> 0 AS confident FROM g WHERE event_type = 'purchase'),
    j AS (SELECT d.cid, min(CASE WHEN d.satellite = u.satellite AND confident THEN idx END) AS idx, max(CASE WHEN d.satellite = u.satellite THEN 1 ELSE 0 END) AS same, count(u.idx) AS k
        FROM d LEFT JOIN truth u ON d.ma > u.lo AND d.mb < u.hi AND {hav('d.lat', 'd.lon', 'u.lat', 'u.lon')} <= 50 GROUP BY d.cid),
    match AS (SELECT cid, CAST(CASE WHEN idx IS NOT NULL THEN idx WHEN k = 0 THEN -1 WHEN same = 1 THEN -2 ELSE -3 END AS BIGINT) AS truth_idx FROM j)"""


def detections(spark, sf_dir):
    f = features.basic(clusters(spark, sf_dir))
    return f.withColumn("score", (F.col("cid") * 7919 % 1000) / 1000.0)


def truth(spark, sf_dir, hours=6):
    g = pe.load_groups(spark, sf_dir).where("event_type = 'purchase'")
    h = F.make_dt_interval(hours=F.lit(hours))
    return g.select(F.col("group_id").alias("idx"), "satellite", "lat", "lon", (F.col("time") - h).alias("start"), (F.col("time") + h).alias("end"), (F.col("group_id") % 3 != 0).alias("confident"))


def matched(spark, sf_dir):
    d = written(detections(spark, sf_dir), "detections")
    return d, joins.truth_match(d, truth(spark, sf_dir))


@query(with_members(f", {_DET} SELECT cid, truth_idx FROM match"))
def j01_truth_match(spark, sf_dir):
    return matched(spark, sf_dir)[1]


@query(with_members(f""", {_DET}, w AS (SELECT *, min(cid) OVER v AS fi, sum(n_groups) OVER v AS gs, max(score) OVER v AS sc, count(*) OVER v AS nc FROM match JOIN d USING (cid) WINDOW v AS (PARTITION BY truth_idx))
    SELECT cid, CASE WHEN truth_idx < 0 OR cid = fi THEN truth_idx ELSE -99 END AS truth_idx, CAST(CASE WHEN truth_idx >= 0 AND cid = fi THEN gs ELSE n_groups END AS BIGINT) AS n_groups, CASE WHEN truth_idx >= 0 AND cid = fi THEN sc ELSE score END AS score, CASE WHEN truth_idx >= 0 AND cid = fi THEN nc ELSE 1 END AS n_combined FROM w"""))
def d14_combine_by_truth(spark, sf_dir):
    d, m = matched(spark, sf_dir)
    return profiles.combined_by_match(d.join(m, "cid").select("cid", "truth_idx", "n_groups", "score"))


@query(with_members(f", {_DET} SELECT d.cid, count(g.group_id) AS n_near, round(count(g.group_id) / CAST(any_value(d.n_groups) AS DOUBLE), 6) AS share FROM d LEFT JOIN (SELECT g.*, label.cid AS own FROM g LEFT JOIN label USING (group_id)) g ON g.satellite = d.satellite AND abs(epoch_us(g.time) / 1e6 - d.t0) <= 7200 AND {hav('d.lat', 'd.lon', 'g.lat', 'g.lon')} <= 500 AND NOT (abs(epoch_us(g.time) / 1e6 - d.t0) <= 600 AND {hav('d.lat', 'd.lon', 'g.lat', 'g.lon')} <= 30) AND coalesce(g.own, -1) <> d.cid GROUP BY d.cid"))
def j02_neighbourhood(spark, sf_dir):
    members = written(clusters(spark, sf_dir, least=1), "members")
    d = features.basic(members).where(F.col("n_groups") >= LEAST_GROUPS)
    g = pe.load_groups(spark, sf_dir).join(members.select("group_id", F.col("cid").alias("own")), "group_id", "left")
    return joins.neighbourhood(d, g, 500.0, 30.0, 600.0, 7200.0).withColumn("share", F.round("share", 6))


@query(with_members("SELECT cid, count(DISTINCT o.group_id) AS n FROM m JOIN (SELECT group_id, satellite, lat, lon, epoch_us(time) / 1e6 AS t FROM g WHERE satellite IN ('G17', 'G18')) o ON m.satellite IN ('G16', 'G19') AND abs(m.lat - o.lat) <= 0.2 AND abs(m.lon - (o.lon + 62)) <= 3 AND abs(m.t - o.t) <= 1800 GROUP BY cid"))
def j03_other_satellite_box(spark, sf_dir):
    east = clusters(spark, sf_dir).where(F.col("satellite").isin(pe.satellites("east")))
    west = pe.load_groups(spark, sf_dir).where(F.col("satellite").isin(pe.satellites("west"))).withColumn("lon", F.col("lon") + 62)
    return joins.other_satellite_box(east, west, 0.2, 3.0, 1800.0).groupBy("cid").agg(F.count("*").alias("n"))


@query(with_members(f""", {_DET}, sp AS (SELECT cid, min(t) AS s, max(t) AS e, CAST(min(time) AS DATE) AS date FROM m GROUP BY cid),
    fl AS (SELECT satellite, satellite || '_' || CAST(date_trunc('hour', time) AS VARCHAR) AS dataset_file, CAST(min(time) AS DATE) AS date, min(epoch_us(time)) / 1e6 AS s, max(epoch_us(time)) / 1e6 AS e FROM g GROUP BY ALL)
    SELECT d.cid, fl.dataset_file FROM d JOIN sp USING (cid) JOIN fl ON fl.satellite <> d.satellite AND fl.date = sp.date WHERE (abs(fl.s - sp.s) < 1200 OR abs(fl.e - sp.e) < 1200)
        AND d.lat BETWEEN -40 AND CASE fl.satellite WHEN 'G16' THEN 20 WHEN 'G17' THEN 30 ELSE 10 END AND d.lon BETWEEN CASE WHEN fl.satellite IN ('G16', 'G19') THEN -90 ELSE -150 END AND CASE WHEN fl.satellite IN ('G16', 'G19') THEN -72 ELSE -100 END"""))
def s10_other_files(spark, sf_dir):
    """Hourly files of other satellites around each cluster, by the fields of view of the stand-in satellites."""
    f = pe.load_groups(spark, sf_dir)
    hour = F.date_trunc("hour", "time")
    f = f.groupBy("satellite", F.concat_ws("_", "satellite", hour.cast("string")).alias("dataset_file")).agg(F.min("time").alias("start"), F.max("time").alias("end"))
    east = F.col("satellite").isin(pe.satellites("east"))
    view = {"south": F.lit(-40.0), "north": F.when(F.col("satellite") == "G16", 20.0).when(F.col("satellite") == "G17", 30.0).otherwise(10.0), "west": F.when(east, -90.0).otherwise(-150.0), "east": F.when(east, -72.0).otherwise(-100.0)}
    return joins.other_files(detections(spark, sf_dir), f.withColumns(view), 1200.0)


@query(with_members(f", {_DET} SELECT cid, score, CAST(CASE WHEN {hav('lat', 'lon', '1.0', '-75.0')} <= 20 THEN 0.6 WHEN {hav('lat', 'lon', '18.0', '-137.0')} <= 1500 THEN 0.8 ELSE 0.0 END AS DOUBLE) AS alpha FROM d"))
def m07_deemphasis(spark, sf_dir):
    d = detections(spark, sf_dir).withColumn("dist", joins.hotspot_distances(None, SPOTS))
    return d.select("cid", "score", scoring.deemphasis(F.col("dist"), RADII, ALPHAS).alias("alpha"))


@query(with_members(f", {_DET} SELECT cid, CASE WHEN n_groups > 25 THEN 'accepted' WHEN cid % 11 = 0 THEN 'N/A' WHEN score < 0.5 THEN 'rejected' ELSE 'accepted' END AS triage, CASE WHEN n_groups > 25 AND (cid % 11 = 0 OR score < 0.8) THEN 'candidate' WHEN cid % 11 = 0 THEN 'N/A' WHEN score < 0.3 THEN 'rejected' WHEN score < 0.8 THEN 'candidate' ELSE 'accepted' END AS validation FROM d"))
def m09_m10_states(spark, sf_dir):
    d = detections(spark, sf_dir)
    score, forced = F.when(F.col("cid") % 11 != 0, F.col("score")), F.col("n_groups") > 25
    return d.select("cid", scoring.triage_state(score, 0.5, forced).alias("triage"), scoring.validation_state(score, 0.3, 0.8, forced).alias("validation"))


@query(with_members(f", {_DET} SELECT cid, score FROM d ORDER BY score DESC, cid LIMIT 20"))
def w06_top_k(spark, sf_dir):
    return detections(spark, sf_dir).orderBy(F.desc("score"), "cid").limit(20).select("cid", "score")


_SCORED = f", {_DET}, s AS (SELECT score, truth_idx >= 0 AS is_true FROM d JOIN match USING (cid))"


def scored(spark, sf_dir):
    d, m = matched(spark, sf_dir)
    return written(d.join(m, "cid").select("cid", "score", "n_groups", (F.col("truth_idx") >= 0).alias("is_true")), "scored")


@query(with_members(f"{_SCORED} SELECT tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE -1 END, 6) AS \"precision\", round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall FROM (SELECT count(*) FILTER (score >= 0.5 AND is_true) AS tp, count(*) FILTER (score >= 0.5 AND NOT is_true) AS fp, count(*) FILTER (score < 0.5 AND is_true) AS fn FROM s)"))
def a14_confusion(spark, sf_dir):
    return scoring.confusion(scored(spark, sf_dir), 0.5).withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


@query(with_members(f"{_SCORED} SELECT round(k / CAST(98 AS DOUBLE), 9) AS threshold, count(*) FILTER (is_true AND r >= k) AS tp, count(*) FILTER (r >= k) AS found, round(count(*) FILTER (is_true AND r >= k) / nullif(count(*) FILTER (r >= k), 0), 6) AS \"precision\", round(count(*) FILTER (is_true AND r >= k) / CAST(count(*) FILTER (is_true) AS DOUBLE), 6) AS recall FROM generate_series(0, 98) t(k), (SELECT *, floor(round(score * 98, 9)) AS r FROM s) GROUP BY k"))
def a15_pr_sweep(spark, sf_dir):
    return scoring.sweep(scored(spark, sf_dir), 99, 0.0).withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


_CURVE = f"{_SCORED}, q AS (SELECT score, sum(t) OVER w AS tp, sum(n) OVER w AS found FROM (SELECT score, count(*) FILTER (is_true) AS t, count(*) AS n FROM s GROUP BY score) WINDOW w AS (ORDER BY score DESC)), c AS (SELECT score, tp, found, tp / found AS p, tp / CAST((SELECT count(*) FROM s WHERE is_true) AS DOUBLE) AS r FROM q)"


@query(with_members(f"{_CURVE} SELECT score, CAST(tp AS BIGINT) AS tp, CAST(found AS BIGINT) AS found, round(p, 6) AS \"precision\", round(r, 6) AS recall FROM c"))
def m26_pr_curve(spark, sf_dir):
    return scoring.curve(scored(spark, sf_dir)).withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


_LIMITED = "SELECT CASE WHEN off <= 0.25 THEN score ELSE CAST('Infinity' AS DOUBLE) END AS z FROM (SELECT round(abs(r - 0.25), 12) AS off, score FROM c ORDER BY 1, 2 LIMIT 1)"


@query(with_members(f"{_CURVE}, o AS ({_LIMITED}) SELECT 'all' AS part, round(sum(st * p), 6) AS average_precision FROM (SELECT p, r - coalesce(lag(r) OVER (ORDER BY score DESC), 0) AS st FROM c) UNION ALL SELECT 'limited', round(sum(CASE WHEN ps < z THEN (r - pr) * p ELSE 0 END) / 0.75, 6) FROM (SELECT p, r, lag(r) OVER (ORDER BY score DESC) AS pr, lag(score) OVER (ORDER BY score DESC) AS ps FROM c), o"))
def w15_average_precision(spark, sf_dir):
    c = written(scoring.curve(scored(spark, sf_dir)), "curve")
    out = scoring.average_precision(c).select(F.lit("all").alias("part"), "average_precision").unionByName(scoring.average_precision(c, 0.25).select(F.lit("limited").alias("part"), "average_precision"))
    return out.withColumn("average_precision", F.round("average_precision", 6))


@query(with_members(f"{_CURVE} SELECT round(coalesce(avg(mr), 0), 6) AS recall, round(coalesce(min(mr), 0), 6) AS least, round(coalesce(max(mr), 0), 6) AS most FROM (SELECT (r + lag(r) OVER w) / 2 AS mr, p, lag(p) OVER w AS pp FROM c WINDOW w AS (ORDER BY score DESC)) WHERE pp IS NOT NULL AND (pp - 0.1) * (p - 0.1) <= 0"))
def w14_recall_at_precision(spark, sf_dir):
    r = scoring.recall_at_precision(scoring.curve(scored(spark, sf_dir)), 0.1)
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


@query(with_members(f"{_SCORED} SELECT round(5.0 * tp / (5.0 * tp + 4.0 * fn + fp), 6) AS f_beta FROM (SELECT count(*) FILTER (score >= 0.5 AND is_true) AS tp, count(*) FILTER (score >= 0.5 AND NOT is_true) AS fp, count(*) FILTER (score < 0.5 AND is_true) AS fn FROM s)"))
def m15_f_beta(spark, sf_dir):
    return scoring.f_beta(scored(spark, sf_dir), 0.5, 2.0).select(F.round("f_beta", 6).alias("f_beta"))


@query(with_members(f", {_DET} SELECT cid, round((lat - min(lat) OVER ()) / (max(lat) OVER () - min(lat) OVER ()), 6) AS lat, round((n_groups - (SELECT median(n_groups) FROM d)) / (SELECT quantile_cont(n_groups, 0.75) - quantile_cont(n_groups, 0.25) FROM d), 6) AS n_groups, round((score - avg(score) OVER ()) / stddev_pop(score) OVER (), 6) AS score FROM d"))
def m01_scaling(spark, sf_dir):
    d = detections(spark, sf_dir).select("cid", "lat", F.col("n_groups").cast("double").alias("n_groups"), "score")
    out = scoring.scaled(d, {"lat": "minmax", "n_groups": "robust", "score": "standard"})
    return out.select("cid", *[F.round(c, 6).alias(c) for c in ("lat", "n_groups", "score")])


@query(with_members(f", {_DET} SELECT cid, round(CASE WHEN truth_idx >= 0 THEN least(20.0, pow(n_groups / (SELECT median(n_groups) FROM d JOIN match USING (cid) WHERE truth_idx >= 0), 2)) ELSE 0.5 END, 6) AS weight FROM d JOIN match USING (cid)"))
def m02_sample_weights(spark, sf_dir):
    s = scored(spark, sf_dir)
    return scoring.sample_weights(s, "n_groups", F.col("is_true")).select("cid", F.round("weight", 6).alias("weight"))


@query(with_members(f", {_DET} SELECT cid, round(1.0 / (count(*) OVER (PARTITION BY truth_idx >= 0) * 2), 9) AS weight FROM d JOIN match USING (cid)"))
def m05_class_weights(spark, sf_dir):
    return scoring.class_weights(scored(spark, sf_dir), "is_true").select("cid", F.round("weight", 9).alias("weight"))


@query("SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(CASE CAST(doc_id % 6 AS INTEGER) WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 0.75 WHEN 3 THEN 0.95 WHEN 4 THEN 0.9 ELSE -1.0 END AS DOUBLE) AS belief FROM labels")
def m11_human_scores(spark, sf_dir):
    words = F.element_at(F.array(*[F.lit(w) for w in ("rejected", "low", "medium", "high", "auto", "other")]), (F.col("doc_id") % 6 + 1).cast("int"))
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), scoring.human_score(words).alias("belief"))


@query("SELECT subject, round(avg(b), 6) AS belief FROM (SELECT CAST(doc_id // 3 AS BIGINT) AS subject, quality * 0.7 + toxic * 0.2 AS b FROM labels) GROUP BY subject")
def m12_machine_belief(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    o = labels.select(F.floor(F.col("doc_id") / 3).alias("subject"), F.lit("machine").alias("source"), (F.col("quality") * 0.7 + F.col("toxic") * 0.2).alias("belief"))
    return scoring.belief(o, "machine").select("subject", F.round("belief", 6).alias("belief"))


@query(with_members(f""", {_DET}, b AS (SELECT cid, 1 / (1 + exp(-(n_groups - 25.0) * 0.07)) AS p, CASE WHEN {hav('lat', 'lon', '1.0', '-75.0')} <= 20 THEN 0.6 WHEN {hav('lat', 'lon', '18.0', '-137.0')} <= 1500 THEN 0.8 ELSE 0.0 END AS alpha, satellite, n_groups FROM d)
    SELECT cid, satellite, n_groups, round(p * (1 - alpha), 6) AS score, CASE WHEN n_groups > 25 THEN 'accepted' WHEN p * (1 - alpha) < 0.2 THEN 'rejected' ELSE 'accepted' END AS triage FROM b ORDER BY p * (1 - alpha) DESC, cid LIMIT 100"""))
def flagship_detections(spark, sf_dir):
    """Scan, cluster, describe, score, set back near hot spots, assess, best first."""
    d = features.basic(clusters(spark, sf_dir)).withColumn("dist", joins.hotspot_distances(None, SPOTS))
    score = membership("group_count", F.col("n_groups")) * (1 - scoring.deemphasis(F.col("dist"), RADII, ALPHAS))
    d = d.withColumn("s", score).orderBy(F.desc("s"), "cid").limit(100)
    return d.select("cid", "satellite", "n_groups", F.round("s", 6).alias("score"), scoring.triage_state(F.col("s"), 0.2, F.col("n_groups") > 25).alias("triage"))
