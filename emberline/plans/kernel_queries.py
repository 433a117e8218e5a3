"""Queries of the array kernels, of streaming operators on stored data and of learned scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.operators import hotspots, joins, kernels
from emberline.sources import point_events as pe
from emberline.streaming import incremental

from .cluster_queries import clusters
from .common import GROUPS, hav, query, with_groups


@query()
def d04_sequential_split(spark, sf_dir):
    return kernels.sequential_split(clusters(spark, sf_dir), 10.0, 1800.0)


@query()
def d07_outlier_rejection(spark, sf_dir):
    return kernels.without_outliers(clusters(spark, sf_dir), least=25)


@query()
def w10_light_curves(spark, sf_dir):
    curves = kernels.light_curves(clusters(spark, sf_dir), 7200.0, 32)
    return curves.select("cid", F.transform("curve", lambda v: F.round(v, 4)).alias("curve"))


_DENSE = """den AS (SELECT CAST(y + dy AS BIGINT) AS y, CAST(x + dx AS BIGINT) AS x, sum(n * exp(-(pow(dy * 2.0 * 111.19, 2) + pow(dx * 2.0 * 111.19 * c, 2)) / (2 * 200.0 * 200.0))) AS density FROM (SELECT *, unnest(generate_series(-r, r)) AS dx FROM (SELECT *, CAST(ceil(3 * 200.0 / 111.19 / 2.0 / c) AS BIGINT) AS r FROM (SELECT floor(lat / 2.0) AS y, floor(lon / 2.0) AS x, count(*) AS n, greatest(0.01, cos(radians((floor(lat / 2.0) + 0.5) * 2.0))) AS c FROM g GROUP BY ALL))), generate_series(-3, 3) a(dy) GROUP BY 1, 2)"""


@query(f"WITH {GROUPS}, {_DENSE} SELECT y, x, round(density, 4) AS density FROM den")
def a22_density(spark, sf_dir):
    d = kernels.density(pe.load_groups(spark, sf_dir), 2.0, 2.0, 200.0)
    return d.select("y", "x", F.round("density", 4).alias("density"))


@query(f"WITH {GROUPS}, {_DENSE} SELECT y, x, round(density / (2 * pi() * 200.0 * 200.0 / (111.19 * 111.19 * greatest(0.01, cos(radians((y + 0.5) * 2.0))))), 5) AS density FROM den")
def a23_calibrated_density(spark, sf_dir):
    d = kernels.density(pe.load_groups(spark, sf_dir), 2.0, 2.0, 200.0, per_degree=True)
    return d.select("y", "x", F.round("density", 5).alias("density"))


@query(f"""WITH {GROUPS}, {_DENSE}, q AS (SELECT y, x, round(density, 6) AS d FROM den), s AS (SELECT 1.4826 * median(abs(d - (SELECT median(d) FROM q))) AS s FROM q)
    SELECT y, x, round(d, 3) AS density FROM q WHERE d > 2.0 * (SELECT s FROM s) AND NOT EXISTS (SELECT 1 FROM q o WHERE abs(o.y - q.y) <= 1 AND abs(o.x - q.x) <= 1 AND (o.y <> q.y OR o.x <> q.x) AND (o.d > q.d OR (o.d = q.d AND (o.y < q.y OR (o.y = q.y AND o.x < q.x)))))""")
def a22_peaks(spark, sf_dir):
    d = kernels.density(pe.load_groups(spark, sf_dir), 2.0, 2.0, 200.0).withColumn("density", F.round("density", 6))
    return kernels.density_peaks(d, 2.0, 2.0, 2.0, 200.0).select("y", "x", F.round("density", 3).alias("density"))


@query()
def w11_stretched_curves(spark, sf_dir):
    return kernels.stretched_curves(clusters(spark, sf_dir), 16)


@query(with_groups("SELECT CAST(k AS INTEGER) AS k, CAST(floor(round((x * cos(k * pi() / 36) + y * sin(k * pi() / 36)) / 2.0, 6)) AS BIGINT) AS rho, count(*) AS votes FROM (SELECT DISTINCT CAST(floor(lat) AS BIGINT) AS y, CAST(floor(lon) AS BIGINT) AS x FROM g), generate_series(0, 35) t(k) GROUP BY ALL"))
def m23_hough_votes(spark, sf_dir):
    pixels = pe.load_groups(spark, sf_dir).select(F.floor("lat").alias("y"), F.floor("lon").alias("x")).distinct()
    return kernels.hough_votes(pixels, 36, 2.0)


@query(f"""WITH RECURSIVE {GROUPS}, p AS (SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS key, satellite, epoch_us(time) / 1e6 AS t, group_id FROM g WHERE satellite IN ('G16', 'G19')),
    l AS (SELECT key, t, row_number() OVER (PARTITION BY key ORDER BY t, group_id) AS i FROM p WHERE satellite = 'G16'),
    c AS (SELECT l.key, l.i, l.t AS t1, list({{'off': abs(r.t - l.t), 't': r.t}} ORDER BY abs(r.t - l.t), r.t) AS near FROM l LEFT JOIN p r ON r.satellite = 'G19' AND r.key = l.key AND abs(r.t - l.t) <= 300 GROUP BY ALL),
    st AS (SELECT DISTINCT key, CAST(0 AS BIGINT) AS i, CAST([] AS DOUBLE[]) AS used, CAST(NULL AS DOUBLE) AS t1, CAST(NULL AS DOUBLE) AS t2 FROM l
        UNION ALL SELECT key, i, CASE WHEN t2 IS NULL THEN used ELSE list_append(used, t2) END, t1, t2 FROM (SELECT st.key, c.i, st.used, c.t1, list_filter(c.near, lambda x: x.t IS NOT NULL AND NOT list_contains(st.used, x.t))[1].t AS t2 FROM st JOIN c ON c.key = st.key AND c.i = st.i + 1))
    SELECT key, t1, t2 FROM st WHERE t2 IS NOT NULL""")
def j04_aligned_times(spark, sf_dir):
    m = pe.load_groups(spark, sf_dir).select(F.to_date("time").cast("string").alias("key"), "satellite", (F.unix_micros("time") / 1e6).alias("t"))
    return joins.aligned_pairs(m.where("satellite = 'G16'"), m.where("satellite = 'G19'"), 300.0)


@query("""WITH s AS (SELECT *, CASE WHEN lag(e) OVER w < t OR lag(e) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM (SELECT satellite, energy, t, max(t + 1800000000) OVER (PARTITION BY satellite ORDER BY t, group_id) AS e, group_id FROM (SELECT satellite, energy, group_id, epoch_us(time) AS t FROM g)) WINDOW w AS (PARTITION BY satellite ORDER BY t, group_id)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY satellite ORDER BY t, group_id) AS k FROM s) SELECT satellite, min(t) AS start_us, count(*) AS n, CAST(sum(energy) AS BIGINT) AS energy FROM r GROUP BY satellite, k""".replace("WITH s", with_groups("").strip() + ", s"))
def st_sessions(spark, sf_dir):
    s = incremental.session_counts(pe.load_groups(spark, sf_dir), "30 minutes")
    return s.select("satellite", F.unix_micros("start").alias("start_us"), "n", "energy")


_ROUNDS = 6


@query(f"""WITH RECURSIVE {GROUPS}, {_DENSE}, q AS (SELECT y, x, round(density, 6) AS d FROM den), s AS (SELECT 1.4826 * median(abs(d - (SELECT median(d) FROM q))) AS s FROM q),
    top AS (SELECT y, x, d FROM q WHERE d > 2.0 * (SELECT s FROM s) AND NOT EXISTS (SELECT 1 FROM q o WHERE abs(o.y - q.y) <= 1 AND abs(o.x - q.x) <= 1 AND (o.y <> q.y OR o.x <> q.x) AND (o.d > q.d OR (o.d = q.d AND (o.y < q.y OR (o.y = q.y AND o.x < q.x)))))),
    nb AS (SELECT t.y, t.x, t.d, coalesce(max(o.d) FILTER (o.y = t.y - 1 AND o.x = t.x), 0) AS ds, coalesce(max(o.d) FILTER (o.y = t.y + 1 AND o.x = t.x), 0) AS dn, coalesce(max(o.d) FILTER (o.x = t.x - 1 AND o.y = t.y), 0) AS dw, coalesce(max(o.d) FILTER (o.x = t.x + 1 AND o.y = t.y), 0) AS de FROM top t JOIN q o ON abs(o.y - t.y) <= 1 AND abs(o.x - t.x) <= 1 GROUP BY ALL),
    st AS (SELECT y, x, CAST((y + 0.5 + CASE WHEN ds - 2 * d + dn < 0 THEN (ds - dn) / (2 * (ds - 2 * d + dn)) ELSE 0 END) * 2.0 AS DOUBLE) AS plat, CAST((x + 0.5 + CASE WHEN dw - 2 * d + de < 0 THEN (dw - de) / (2 * (dw - 2 * d + de)) ELSE 0 END) * 2.0 AS DOUBLE) AS plon FROM nb),
    sh AS (SELECT y, x, 0 AS i, plat, plon, CAST(0 AS DOUBLE) AS density FROM st UNION ALL SELECT y, x, i + 1, degrees(atan2(sum(w * sin(radians(lat))), sqrt(pow(sum(w * cos(radians(lat)) * cos(radians(lon))), 2) + pow(sum(w * cos(radians(lat)) * sin(radians(lon))), 2)))), degrees(atan2(sum(w * cos(radians(lat)) * sin(radians(lon))), sum(w * cos(radians(lat)) * cos(radians(lon))))), sum(w)
        FROM (SELECT sh.*, g.lat, g.lon, exp(-pow({hav('plat', 'plon', 'g.lat', 'g.lon')}, 2) / (2 * 200.0 * 200.0)) AS w FROM sh JOIN g ON {hav('plat', 'plon', 'g.lat', 'g.lon')} <= 600 WHERE i < {_ROUNDS}) GROUP BY y, x, i),
    e AS (SELECT * FROM sh WHERE i = {_ROUNDS}), r AS (SELECT e.y, e.x, floor(round({hav('plat', 'plon', 'g.lat', 'g.lon')} / 10.0, 6)) AS ring, count(*) AS n FROM e JOIN g ON {hav('plat', 'plon', 'g.lat', 'g.lon')} <= 300 GROUP BY ALL HAVING floor(round({hav('any_value(plat)', 'any_value(plon)', 'any_value(g.lat)', 'any_value(g.lon)')} / 10.0, 6)) < 30),
    th AS (SELECT y, x, ring, n / (2 * ring + 1) AS thick FROM r), mx AS (SELECT y, x, max(thick) AS most, arg_min(ring, (-thick, ring)) AS densest FROM th GROUP BY y, x),
    rad AS (SELECT mx.y, mx.x, coalesce(min(k), 30) * 10.0 AS radius FROM mx LEFT JOIN (SELECT mx.y, mx.x, k FROM mx, generate_series(0, 29) t(k) LEFT JOIN th ON th.y = mx.y AND th.x = mx.x AND th.ring = k WHERE k > densest AND coalesce(thick, 0) <= 0.1 * most) c ON c.y = mx.y AND c.x = mx.x GROUP BY mx.y, mx.x)
    SELECT round(plat, 3) AS lat, round(plon, 3) AS lon, round(density, 2) AS density, CAST(radius AS DOUBLE) AS radius_km FROM e LEFT JOIN rad USING (y, x)""")
def a22_hot_spots(spark, sf_dir):
    """Peaks after a fixed number of steps of mean shift from the grid's maxima, with the rings of points around them."""
    g = pe.load_groups(spark, sf_dir).select("lat", "lon")
    found = hotspots.peak_places(g, 2.0, 2.0, 200.0, rounds=_ROUNDS, tolerance_km=0.0)
    out = hotspots.peak_radii(g, found, 10.0, 300.0)
    return out.select(F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"), F.round("density", 2).alias("density"), "radius_km")


@query(f"""WITH {GROUPS}, {_DENSE}, rw AS (SELECT DISTINCT y, (y + 0.5) * 2.0 AS plat FROM den), gl AS (SELECT y, {hav('plat', '0.0', '(b - 89.5)', 'CAST(a AS DOUBLE)')} AS km FROM rw, generate_series(0, 179) t(b), generate_series(0, 359) u(a)),
    rf AS (SELECT y, sum(exp(-km * km / (2 * 200.0 * 200.0))) AS reference FROM gl WHERE km <= 600 GROUP BY y) SELECT y, x, round(density / reference, 5) AS density FROM den JOIN rf USING (y)""")
def a23_globe_density(spark, sf_dir):
    """Density by that of one point to every square degree of the globe, which is added up by great-circle distance."""
    d = kernels.density(pe.load_groups(spark, sf_dir), 2.0, 2.0, 200.0)
    rows = d.join(hotspots.grid_reference(spark, 2.0, 200.0), "y")
    return rows.select("y", "x", F.round(F.col("density") / F.col("reference"), 5).alias("density"))
