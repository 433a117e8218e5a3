"""Queries of streaks: edges and segments of the days' images, and planes of time through clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.operators import streaks
from emberline.sources import point_events as pe

from .cluster_queries import clusters
from .common import GROUPS, query, with_members

_SIZE = 48
_PIXELS = f"""{GROUPS}, day AS (SELECT *, date_diff('day', DATE '2024-01-01', CAST(time AS DATE)) AS k FROM g), span AS (SELECT k, min(lat) AS s, max(lat) AS n, min(lon) AS w, max(lon) AS e FROM day GROUP BY k),
    px AS (SELECT DISTINCT k, CAST(CASE WHEN n > s THEN floor((lat - s) / (n - s) * {_SIZE - 1}) ELSE 0 END AS BIGINT) AS x, CAST(CASE WHEN e > w THEN floor((lon - w) / (e - w) * {_SIZE - 1}) ELSE 0 END AS BIGINT) AS y FROM day JOIN span USING (k))"""


def _pixels(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).withColumn("k", F.datediff(F.to_date("time"), F.lit("2024-01-01").cast("date")).cast("long"))
    return streaks.rasterized(g, "k", _SIZE, _SIZE).select("k", "x", "y").distinct()


_WEIGHTS = ", ".join(f"({i - streaks.REACH - 1}, CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE))" for i, (a, b) in enumerate(zip(*streaks.gradient_weights(1.0), strict=True)))
_FLAT = "0.41421356237309503"


@query(f"""WITH RECURSIVE {_PIXELS}, wt(d, along, across) AS (VALUES {_WEIGHTS}),
    gr AS (SELECT k, x + a.d AS x, y + b.d AS y, round(sum(a.along * b.across), 6) AS gx, round(sum(a.across * b.along), 6) AS gy FROM px, wt a, wt b WHERE x + a.d BETWEEN 0 AND {_SIZE - 1} AND y + b.d BETWEEN 0 AND {_SIZE - 1} GROUP BY ALL),
    st AS (SELECT *, round(sqrt(gx * gx + gy * gy), 6) AS m FROM gr),
    dr AS (SELECT *, CASE WHEN abs(gx) < {_FLAT} * abs(gy) THEN 0 ELSE 1 END AS dx, CASE WHEN abs(gy) < {_FLAT} * abs(gx) THEN 0 WHEN gx * gy >= 0 OR abs(gx) < {_FLAT} * abs(gy) THEN 1 ELSE -1 END AS dy FROM st WHERE m >= 0.1 AND x BETWEEN 1 AND {_SIZE - 2} AND y BETWEEN 1 AND {_SIZE - 2}),
    thin AS (SELECT d.k, d.x, d.y, d.m FROM dr d LEFT JOIN st b ON b.k = d.k AND b.x = d.x - d.dx AND b.y = d.y - d.dy LEFT JOIN st a ON a.k = d.k AND a.x = d.x + d.dx AND a.y = d.y + d.dy WHERE d.m > coalesce(b.m, 0) AND d.m >= coalesce(a.m, 0)),
    r AS (SELECT k, x, y, x AS x2, y AS y2 FROM thin WHERE m >= 0.2 UNION SELECT r.k, r.x, r.y, t.x, t.y FROM r JOIN thin t ON t.k = r.k AND abs(t.x - r.x2) <= 1 AND abs(t.y - r.y2) <= 1)
    SELECT k, x, y, round(m, 4) AS strength FROM thin WHERE (k, x, y) IN (SELECT (k, x2, y2) FROM r)""")
def m23_edges(spark, sf_dir):
    e = streaks.edge_pixels(_pixels(spark, sf_dir), "k", _SIZE, _SIZE)
    return e.select("k", "x", "y", F.round("strength", 4).alias("strength"))


@query(f"""WITH {_PIXELS}, v AS (SELECT k, x, y, CAST(a AS INTEGER) AS angle, CAST(floor(round((x * cos(a * pi() / 36) + y * sin(a * pi() / 36)) / 4.0, 6)) AS BIGINT) AS rho FROM px, generate_series(0, 35) t(a)),
    c AS (SELECT k, angle, rho, count(*) AS votes FROM v GROUP BY ALL HAVING count(*) >= 5),
    p AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.k = c.k AND abs(o.angle - c.angle) <= 1 AND abs(o.rho - c.rho) <= 1 AND (o.votes > c.votes OR (o.votes = c.votes AND (o.angle < c.angle OR (o.angle = c.angle AND o.rho < c.rho)))))),
    o AS (SELECT k, x, y, angle, rho, round(y * cos(angle * pi() / 36) - x * sin(angle * pi() / 36), 6) AS s FROM (SELECT v.*, row_number() OVER (PARTITION BY v.k, v.x, v.y ORDER BY votes DESC, v.angle, v.rho) AS i FROM v JOIN p USING (k, angle, rho)) WHERE i = 1),
    n AS (SELECT *, CASE WHEN s - lag(s) OVER w <= 12 THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY k, angle, rho ORDER BY s, y, x)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY k, angle, rho ORDER BY s, y, x) AS segment FROM n)
    SELECT k, angle, rho, CAST(segment AS BIGINT) AS segment, count(*) AS n_pixels, round(max(s) - min(s), 4) AS length, arg_min(x, (s, y, x)) AS x0, arg_min(y, (s, y, x)) AS y0, arg_max(x, (s, y, x)) AS x1, arg_max(y, (s, y, x)) AS y1
    FROM r GROUP BY k, angle, rho, segment HAVING round(max(s) - min(s), 4) >= 15""")
def m23_streak_segments(spark, sf_dir):
    found, _ = streaks.segments(_pixels(spark, sf_dir), "k", 36, 4.0, 5, 15.0, 12.0)
    return found


_TRIALS = 20


def _hash(k: int) -> str:
    a, b, c = streaks.PICKS[k]
    return f"((h * {a} + (cid % {streaks.PICK_RANGE}) * {b} + {c}) % {streaks.PICK_RANGE})"


@query(with_members("").rstrip() + f""", q AS (SELECT cid, CAST(i - 1 AS BIGINT) AS i, CAST(n AS BIGINT) AS n, lon - first_value(lon) OVER w AS x, lat - first_value(lat) OVER w AS y, (epoch_us(time) / 1e6 - epoch_us(first_value(time) OVER w) / 1e6) / 60 AS z FROM m WINDOW w AS (PARTITION BY cid ORDER BY i)),
    mid AS (SELECT cid, median(z) AS middle FROM q GROUP BY cid), wid AS (SELECT cid, median(abs(z - middle)) AS lim FROM q JOIN mid USING (cid) GROUP BY cid),
    h0 AS (SELECT cid, n, CAST(h AS BIGINT) AS h FROM (SELECT DISTINCT cid, n FROM q), generate_series(0, {_TRIALS - 1}) t(h)),
    h1 AS (SELECT *, {_hash(0)} % n AS one FROM h0), h2 AS (SELECT *, (one + 1 + {_hash(1)} % (n - 1)) % n AS two, {_hash(2)} % (n - 2) AS t FROM h1),
    h3 AS (SELECT *, t + CASE WHEN t >= least(one, two) THEN 1 ELSE 0 END AS t2 FROM h2), h4 AS (SELECT *, t2 + CASE WHEN t2 >= greatest(one, two) THEN 1 ELSE 0 END AS three FROM h3),
    tri AS (SELECT h4.cid, h, a.x AS x0, a.y AS y0, a.z AS z0, b.x - a.x AS dx1, b.y - a.y AS dy1, b.z - a.z AS dz1, c.x - a.x AS dx2, c.y - a.y AS dy2, c.z - a.z AS dz2
        FROM h4 JOIN q a ON a.cid = h4.cid AND a.i = one JOIN q b ON b.cid = h4.cid AND b.i = two JOIN q c ON c.cid = h4.cid AND c.i = three),
    det AS (SELECT *, round(dx1 * dy2 - dx2 * dy1, 12) AS det FROM tri),
    far AS (SELECT *, dx1 * dx1 + dy1 * dy1 AS l1, dx2 * dx2 + dy2 * dy2 AS l2 FROM det),
    pl AS (SELECT cid, h, x0, y0, z0, CASE WHEN det <> 0 THEN (dz1 * dy2 - dz2 * dy1) / det WHEN l1 >= l2 THEN dz1 / l1 * dx1 ELSE dz2 / l2 * dx2 END AS a, CASE WHEN det <> 0 THEN (dx1 * dz2 - dx2 * dz1) / det WHEN l1 >= l2 THEN dz1 / l1 * dy1 ELSE dz2 / l2 * dy2 END AS b
        FROM far WHERE det <> 0 OR round(greatest(l1, l2), 12) > 0),
    sc AS (SELECT q.cid, h, round(abs(z - z0 - a * (x - x0) - b * (y - y0)), 6) AS off, lim FROM q JOIN pl ON q.cid = pl.cid JOIN wid ON q.cid = wid.cid),
    agg AS (SELECT cid, h, count(*) AS cnt, round(sum(off * off), 4) AS error FROM sc WHERE off <= lim GROUP BY cid, h),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY cnt DESC, error, h) AS rk FROM agg) WHERE rk = 1),
    kept AS (SELECT q.* FROM q JOIN best ON q.cid = best.cid JOIN pl ON pl.cid = best.cid AND pl.h = best.h JOIN wid ON wid.cid = q.cid WHERE round(abs(z - z0 - a * (x - x0) - b * (y - y0)), 6) <= lim),
    fit AS (SELECT cid, any_value(n) AS n, count(*) AS n_inliers, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(y, y) AS yy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz, covar_pop(z, z) AS zz FROM kept GROUP BY cid),
    slo AS (SELECT *, round(xx * yy - xy * xy, 15) > 0 AS plane, CASE WHEN round(xx * yy - xy * xy, 15) > 0 THEN ((xz * yy - yz * xy) * xz + (yz * xx - xz * xy) * yz) / (xx * yy - xy * xy) WHEN xx >= yy THEN CASE WHEN xx > 0 THEN xz * xz / xx ELSE 0 END ELSE yz * yz / yy END AS told FROM fit)
    SELECT cid, n, n_inliers, round(told / zz, 3) AS r2, round(greatest(zz - told, 0.0), 2) AS mse FROM slo WHERE round(zz, 9) > 0 AND round(told / zz, 3) >= 0.3""")
def m22_consensus_lines(spark, sf_dir):
    lines = streaks.consensus_lines(clusters(spark, sf_dir), _TRIALS)
    return lines.select("cid", "n", "n_inliers", F.round("r2", 3).alias("r2"), F.round("mse", 2).alias("mse")).where("r2 >= 0.3")
