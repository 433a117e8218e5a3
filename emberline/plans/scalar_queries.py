"""Queries of scalar functions, filters, scans and joins on the point groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.functions import geo, membership, times
from emberline.operators import joins
from emberline.operators.scan import time_cell
from emberline.sources import point_events as pe

from .common import GROUPS, hav, query, with_groups

SPOTS = [(1.0, -75.0), (18.0, -137.0)]
RADII, ALPHAS = [20.0, 1500.0], [0.6, 0.8]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(with_groups("SELECT group_id, round(((CAST(lon * 3 AS DOUBLE) + 180.0) - 360.0 * floor((lon * 3 + 180.0) / 360.0)) - 180.0, 6) AS wrapped FROM g"))
def p01_wrap_lon(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(geo.wrap_lon(F.col("lon") * 3), 6).alias("wrapped"))


@query(with_groups("SELECT group_id, round(CASE WHEN lon + 260 > 150 THEN lon + 260 - 360 ELSE lon + 260 END, 6) AS unwrapped FROM g"))
def p02_unwrap_lon(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(geo.unwrap_lon(F.col("lon") + 260), 6).alias("unwrapped"))


@query(with_groups(f"SELECT group_id, satellite, energy FROM g WHERE lat BETWEEN -20 AND 30 AND (CASE WHEN lon > 150 THEN lon - 360 ELSE lon END) BETWEEN -140 AND -70 AND time >= TIMESTAMP '2024-01-05' "))
def p03_box(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    return g.where(F.col("lat").between(-20, 30) & geo.unwrap_lon(F.col("lon")).between(-140, -70) & (F.col("time") >= F.lit("2024-01-05").cast("timestamp"))).select("group_id", "satellite", "energy")


_T = "greatest(0.0, least(1.0, ((lon + 140) * 70 + (lat + 10) * 20) / 5300.0))"


@query(with_groups(f"SELECT group_id, round(km, 4) AS km FROM (SELECT group_id, {hav('lat', 'lon', f'(-10 + {_T} * 20)', f'(-140 + {_T} * 70)')} AS km FROM g) WHERE km <= 900"))
def p05_corridor(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).withColumn("km", geo.corridor_km(F.col("lat"), F.col("lon"), -10.0, -140.0, 10.0, -70.0))
    return g.where("km <= 900").select("group_id", F.round("km", 4).alias("km"))


@query(with_groups("SELECT satellite, count(*) AS n, sum(energy) AS energy FROM g WHERE satellite IN ('G16', 'G19') GROUP BY satellite"))
def p06_satellites(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).where(F.col("satellite").isin(pe.satellites("east")))
    return g.groupBy("satellite").agg(F.count("*").alias("n"), F.sum("energy").alias("energy"))


@query(with_groups("SELECT group_id FROM g WHERE CAST(time AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'"))
def p07_date_range(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).where(F.to_date("time").between("2024-01-03", "2024-01-09")).select("group_id")


@query(with_groups(f"SELECT group_id, round({hav('lat', 'lon', '1.0', '-75.0')}, 4) AS km FROM g WHERE {hav('lat', 'lon', '1.0', '-75.0')} <= 2500"))
def p17_within_radius(spark, sf_dir):
    km = geo.haversine(F.col("lat"), F.col("lon"), F.lit(1.0), F.lit(-75.0))
    return pe.load_groups(spark, sf_dir).withColumn("km", km).where("km <= 2500").select("group_id", F.round("km", 4).alias("km"))


@query("""SELECT k, id, coalesce(TRY_CAST(id AS BIGINT) < 0 OR TRY_CAST(id AS BIGINT) > 4294967295, false) AS valid FROM (SELECT CAST(o_orderkey AS BIGINT) AS k, CASE o_orderkey % 5 WHEN 0 THEN '1620240101000000' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
    WHEN 1 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN 'id' || CAST(o_orderkey AS VARCHAR) WHEN 3 THEN '99999999999999999999' END AS id FROM orders)""")
def p18_valid_ids(spark, sf_dir):
    k, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    made = F.when(k % 5 == 0, F.concat(F.lit("1620240101000000"), F.lpad((k % 1000).cast("string"), 3, "0"))).when(k % 5 == 1, text).when(k % 5 == 2, F.concat(F.lit("id"), text)).when(k % 5 == 3, F.lit("99999999999999999999"))
    return table(spark, sf_dir, "orders").select(k.cast("long").alias("k"), made.alias("id")).withColumn("valid", times.valid_id(F.col("id")))


@query(with_groups(f"SELECT group_id, round({hav('lat', 'lon', '10.0', '-100.0')}, 4) AS km, round({hav('lat', 'lon', '10.0', '-100.0', '(180.0 / pi())')}, 6) AS degrees FROM g"))
def f01_haversine(spark, sf_dir):
    import math

    g = pe.load_groups(spark, sf_dir)
    d = lambda r: geo.haversine(F.col("lat"), F.col("lon"), F.lit(10.0), F.lit(-100.0), r)
    return g.select("group_id", F.round(d(geo.EARTH_KM), 4).alias("km"), F.round(d(180 / math.pi), 6).alias("degrees"))


_D = "(500.0 / 6371.0)"
_LAT2 = f"asin(sin(radians(lat)) * cos({_D}) + cos(radians(lat)) * sin({_D}) * cos(radians(60.0)))"


@query(with_groups(f"SELECT group_id, round(degrees({_LAT2}), 6) AS lat2, round(degrees(radians(lon) + atan2(sin(radians(60.0)) * sin({_D}) * cos(radians(lat)), cos({_D}) - sin(radians(lat)) * sin({_LAT2}))), 6) AS lon2 FROM g"))
def f03_destination(spark, sf_dir):
    lat2, lon2 = geo.destination(F.col("lat"), F.col("lon"), F.lit(60.0), F.lit(500.0))
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(lat2, 6).alias("lat2"), F.round(lon2, 6).alias("lon2"))


_B = "atan2(sin(radians(lon + 100.0)) * cos(radians(10.0)), cos(radians(lat)) * sin(radians(10.0)) - sin(radians(lat)) * cos(radians(10.0)) * cos(radians(lon + 100.0)))"


@query(with_groups(f"SELECT group_id, round(CASE WHEN {_B} < 0 THEN {_B} + 2 * pi() ELSE {_B} END, 6) AS bearing FROM g"))
def f04_bearing(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(geo.bearing(F.col("lat"), F.col("lon"), F.lit(10.0), F.lit(-100.0)), 6).alias("bearing"))


@query(with_groups("SELECT group_id, round((energy - 7.0) / 2 * (sin(2 * radians(lat) + pi() / 2) + 1) + 7.0, 6) AS radius FROM g"))
def f05_ellipse_radius(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(geo.ellipse_radius(F.radians("lat"), F.col("energy"), F.lit(7.0)), 6).alias("radius"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(i AS INTEGER) AS i, round(degrees(asin(sin(radians(n_nationkey * 2.0)) * cos(200.0 / 6371.0) + cos(radians(n_nationkey * 2.0)) * sin(200.0 / 6371.0) * cos(radians(i * 30.0)))), 6) AS lat FROM nation, generate_series(0, 11) t(i)")
def f06_circle(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("c", geo.circle(F.col("n_nationkey") * 2.0, F.lit(10.0), F.lit(200.0), 12))
    return n.select(F.col("n_nationkey").cast("long").alias("id"), F.posexplode("c").alias("i", "p")).select("id", "i", F.round("p.lat", 6).alias("lat"))


@query(with_groups("SELECT satellite, arg_max(group_id, lat * 1000000 + group_id / 1e7) AS north, arg_min(group_id, lat * 1000000 + group_id / 1e7) AS south FROM g GROUP BY satellite"))
def f07_furthest(spark, sf_dir):
    o = F.col("lat") * 1000000 + F.col("group_id") / 1e7
    return pe.load_groups(spark, sf_dir).groupBy("satellite").agg(F.max_by("group_id", o).alias("north"), F.min_by("group_id", o).alias("south"))


_BX, _BY = "(cos(radians(10.0)) * cos(radians(-100.0 - lon)))", "(cos(radians(10.0)) * sin(radians(-100.0 - lon)))"


@query(with_groups(f"SELECT group_id, round(degrees(atan2(sin(radians(lat)) + sin(radians(10.0)), sqrt(pow(cos(radians(lat)) + {_BX}, 2) + pow({_BY}, 2)))), 6) AS lat, round(lon + degrees(atan2({_BY}, cos(radians(lat)) + {_BX})), 6) AS lon FROM g"))
def f08_midpoint(spark, sf_dir):
    lat, lon = geo.midpoint(F.col("lat"), F.col("lon"), F.lit(10.0), F.lit(-100.0))
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


_STAMP = "strftime(time, '%Y%j%H%M%S') || CAST(CAST(floor((epoch_us(time) % 1000000) / 100000) AS INTEGER) AS VARCHAR)"


@query(with_groups(f"SELECT group_id, {_STAMP} AS stamp FROM g"))
def f09_stamp(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", times.stamp(F.col("time")).alias("stamp"))


@query(with_groups("SELECT group_id, CAST(floor(epoch_us(time) / 100000) AS BIGINT) AS tenths FROM g"))
def f10_parse_stamp(spark, sf_dir):
    back = times.from_stamp(times.stamp(F.col("time")))
    return pe.load_groups(spark, sf_dir).select("group_id", F.floor(F.unix_micros(back) / 100000).cast("long").alias("tenths"))


@query(with_groups("SELECT group_id, round((epoch_us(time) - epoch_us(TIMESTAMP '2000-01-01 12:00:00')) / 1e6, 6) AS j2000 FROM g"))
def f11_j2000_seconds(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", F.round(times.j2000_seconds(F.col("time")), 6).alias("j2000"))


@query(with_groups("SELECT group_id, strftime(time, '%Y-%m-%dT%H:%M:%S') || '.' || CAST(group_id % 10 AS VARCHAR) || '00' AS iso FROM g"))
def f12_iso_millis(spark, sf_dir):
    text = F.concat(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), (F.col("group_id") % 10).cast("string"), F.lit("Z"))
    return pe.load_groups(spark, sf_dir).select("group_id", times.iso_millis(text).alias("iso"))


@query(with_groups("SELECT group_id, epoch_us(time) + CAST(round(lon / 15 * 3600000000) AS BIGINT) AS local_us FROM g"))
def f13_local_time(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", F.unix_micros(times.local_solar(F.col("time"), F.col("lon"))).alias("local_us"))


@query(with_groups("SELECT group_id, CAST(CAST(time AS DATE) AS VARCHAR) AS by_day, CAST(CAST(time AS DATE) AS VARCHAR) AS by_month, CAST(CAST(time AS DATE) AS VARCHAR) AS by_name FROM g"))
def f15_iso_date(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    paths = {"by_day": "'/data/'yyyy'/'DDD'/'HH'/f.nc'", "by_month": "'/data/'yyyy'/'MMdd'/f.nc'", "by_name": "'/data/f_'yyyy'_'MM'_'dd'.nc'"}
    return g.select("group_id", *[times.date_of_path(F.date_format("time", p)).cast("string").alias(n) for n, p in paths.items()])


@query(with_groups("SELECT satellite || '_' || strftime(time, '%Y-%m-%dT%Hh%Mm%S') || '_' || printf('%.2f', lat) || '_' || printf('%.2f', lon) || '_' || CAST(group_id AS VARCHAR) AS name FROM g"))
def f19_report_name(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select(times.report_name(F.col("satellite"), F.col("time"), F.col("lat"), F.col("lon"), F.col("group_id")).alias("name"))


@query(with_groups("SELECT group_id, CASE WHEN satellite IN ('G16', 'G17', 'G18', 'G19') THEN satellite END AS found FROM g"))
def s09_satellite_of_path(spark, sf_dir):
    path = F.concat(F.lit("/data/GOES"), F.substring("satellite", 2, 2), F.lit("/x.nc"))
    return pe.load_groups(spark, sf_dir).select("group_id", times.satellite_of_path(path).alias("found"))


def _curve(feature, x):
    falls, log, steep, centre = membership.CURVES[feature]
    v = f"log10({x})" if log else x
    p = f"1 / (1 + exp(-(({v}) - ({centre})) * {steep}))"
    return f"round(1 - {p}, 6)" if falls else f"round({p}, 6)"


_XS = {"max_distance_km": "energy / 1000.0", "median_linelet": "energy / 1e6 + 1e-9", "time_duration": "energy / 100.0", "line_fit_residual": "energy / 1e6 + 1e-9", "group_count": "energy / 10.0", "energy_balance": "energy / 1e4", "max_line_distance": "energy / 1e6", "max_line_distance_ratio": "energy / 1e4", "mean_spline_residual": "energy / 1e4 + 1e-9"}


@query(with_groups("SELECT group_id, " + ", ".join(f"{_curve(f, x)} AS {f}" for f, x in _XS.items()) + " FROM g"))
def l01_l09_memberships(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).select("group_id", *[F.round(membership.membership(f, F.expr(x)), 6).alias(f) for f, x in _XS.items()])


@query(with_groups(f"""SELECT group_id, round(b, 6) AS probability FROM (SELECT *, a * {_curve('energy_balance', 'energy / 1e4')[6:-4]} AS b FROM
    (SELECT *, {_curve('group_count', 'energy / 10.0')[6:-4]} AS a FROM g) WHERE a >= 0.3) WHERE b >= 0.5"""))
def l10_cascade(spark, sf_dir):
    steps = [("group_count", F.col("energy") / 10.0, 0.3), ("energy_balance", F.col("energy") / 1e4, 0.5)]
    return membership.cascade(pe.load_groups(spark, sf_dir), steps).select("group_id", F.round("probability", 6).alias("probability"))


@query(with_groups("SELECT group_id, round(lat, 5) AS lat, round(lon, 5) AS lon, round(h, 4) AS height FROM (SELECT group_id, lat, lon, energy / 1000.0 AS h FROM g)"))
def c02_geodetic_round_trip(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    x, y, z = geo.to_ecef(F.col("lat"), F.col("lon"), F.col("energy") / 1000.0)
    g = g.select("group_id", x.alias("x"), y.alias("y"), z.alias("z"))
    lat, lon, h = geo.from_ecef(F.col("x"), F.col("y"), F.col("z"))
    return g.select("group_id", F.round(lat, 5).alias("lat"), F.round(lon, 5).alias("lon"), F.round(h, 4).alias("height"))


@query(with_groups("SELECT group_id, round(lat, 5) AS lat, round(lon, 5) AS lon FROM g WHERE abs(lat) < 60 AND satellite IN ('G16', 'G19')"))
def c01_renavigate_there_and_back(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).where((F.abs("lat") < 60) & F.col("satellite").isin(pe.satellites("east")))
    up_lat, up_lon = geo.renavigated(F.col("lat"), F.col("lon"), 16.0, 80.0, -75.2)
    g = g.select("group_id", up_lat.alias("a"), up_lon.alias("o"))
    lat, lon = geo.renavigated(F.col("a"), F.col("o"), 80.0, 16.0, -75.2)
    return g.select("group_id", F.round(lat, 5).alias("lat"), F.round(lon, 5).alias("lon"))


@query(with_groups("""SELECT group_id, h * px >= py * py + pow(6378.137 / 6356.752314245, 2) * pz * pz AS visible, round(asin(py / sqrt(pow(h - px, 2) + py * py + pz * pz)), 7) AS x, round(atan2(pz, h - px), 7) AS y FROM (SELECT group_id, 42164.0 AS h, n * cos(p) * cos(d) AS px, n * cos(p) * sin(d) AS py, n * (1 - e2) * sin(p) AS pz
    FROM (SELECT *, 6378.137 / sqrt(1 - e2 * pow(sin(p), 2)) AS n FROM (SELECT group_id, radians(lat) AS p, radians(lon + 75.0) AS d, 1 - pow(6356.752314245 / 6378.137, 2) AS e2 FROM g)))"""))
def c07_grid_in_view(spark, sf_dir):
    """Scan angles of all groups as an imager at 75 west has them, by the geocentric latitude; the SQL goes by Earth-fixed positions."""
    x, y, visible = geo.fixed_grid(F.col("lat"), F.col("lon"), -75.0)
    return pe.load_groups(spark, sf_dir).select("group_id", visible.alias("visible"), F.round(x, 7).alias("x"), F.round(y, 7).alias("y"))


@query(with_groups("SELECT group_id, satellite, dataset_file, energy FROM g WHERE quality = 0 AND energy > 0"))
def s01_scan_filter(spark, sf_dir):
    return pe.scan_groups(pe.load_groups(spark, sf_dir)).select("group_id", "satellite", "dataset_file", "energy")


_FILES = f"{GROUPS}, f AS (SELECT satellite, dataset_file, min(time) AS s, max(time) AS e, count(*) AS n FROM g GROUP BY ALL), w AS (SELECT *, lag(dataset_file) OVER o AS p, lead(dataset_file) OVER o AS q, epoch_us(s) / 1e6 - epoch_us(lag(s) OVER o) / 1e6 AS back, epoch_us(lead(e) OVER o) / 1e6 - epoch_us(e) / 1e6 AS ahead FROM f WINDOW o AS (PARTITION BY satellite ORDER BY s, dataset_file))"


@query(f"WITH {_FILES} SELECT satellite, dataset_file AS \"primary\", dataset_file, true AS is_primary FROM w UNION ALL SELECT satellite, dataset_file, p, false FROM w WHERE back < 90000 UNION ALL SELECT satellite, dataset_file, q, false FROM w WHERE ahead < 90000")
def s03_file_neighbours(spark, sf_dir):
    return pe.with_neighbours(pe.file_table(pe.load_groups(spark, sf_dir)), 90000)


@query(with_groups("SELECT group_id FROM g WHERE time >= (SELECT max(time) FROM g) - INTERVAL 3600 SECOND AND group_id % 7 <> 0"))
def s04_window_events(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    last = g.agg(F.max("time").alias("t0"))
    listed = g.where("group_id % 7 = 0").select("dataset_file", "group_id")
    return pe.events_around(g.crossJoin(F.broadcast(last)), F.col("t0"), 3600, listed).select("group_id")


@query(with_groups("SELECT dataset_file, group_id, count(*) AS n_children, CAST(sum(e) AS BIGINT) AS child_energy FROM (SELECT dataset_file, group_id - group_id % 5 AS group_id, energy AS e FROM g) JOIN (SELECT dataset_file, group_id FROM g) USING (dataset_file, group_id) GROUP BY ALL"))
def s05_children(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    return pe.children(g, g.select("dataset_file", (F.col("group_id") - F.col("group_id") % 5).alias("parent_group_id"), "energy"))


@query(f"WITH {_FILES}, x AS (SELECT dataset_file AS pr, dataset_file AS df, s, e, true AS own FROM w UNION ALL SELECT dataset_file, p, s, e, false FROM w WHERE back < 90000 UNION ALL SELECT dataset_file, q, s, e, false FROM w WHERE ahead < 90000) SELECT pr AS \"primary\", count(*) AS n FROM x JOIN g ON g.dataset_file = x.df WHERE own OR time BETWEEN s - INTERVAL 6000 SECOND AND e + INTERVAL 6000 SECOND GROUP BY pr")
def s07_primary_windows(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    files = pe.file_table(g)
    return pe.primary_windows(g, pe.with_neighbours(files, 90000), files, 600.0).groupBy("primary").agg(F.count("*").alias("n"))


@query(with_groups("""SELECT l.group_id AS key, max_by(r.name, r.time) FILTER (r.time <= l.time) AS before, min_by(r.name, r.time) FILTER (r.time > l.time) AS after
    FROM g l LEFT JOIN (SELECT satellite, max(time) AS time, dataset_file AS name FROM g GROUP BY ALL) r ON l.satellite = r.satellite GROUP BY l.group_id"""))
def s11_asof_files(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    left = g.select("satellite", "time", F.col("group_id").alias("key"))
    right = g.groupBy("satellite", F.col("dataset_file").alias("name")).agg(F.max("time").alias("time"))
    return joins.asof_neighbours(left, right, "satellite")


@query(with_groups(f"SELECT group_id, round({hav('lat', 'lon', '1.0', '-75.0')}, 4) AS first, round({hav('lat', 'lon', '18.0', '-137.0')}, 4) AS second FROM g"))
def j05_hotspot_distances(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).withColumn("d", joins.hotspot_distances(None, SPOTS))
    return g.select("group_id", F.round(F.col("d")[0], 4).alias("first"), F.round(F.col("d")[1], 4).alias("second"))


@query(with_groups("""SELECT p.group_id AS key, arg_min(px, o) AS x, arg_min(py, o) AS y FROM (SELECT p.group_id, px, py, struct_pack(d := round(pow(lat - (py * 0.1 - 60), 2) + pow(lon - (px * 0.1 - 140), 2), 12), x := px, y := py) AS o
    FROM g p, generate_series(-1, 1) a(i), generate_series(-1, 1) b(j), LATERAL (SELECT CAST(round((lon + 140) / 0.1) AS BIGINT) + i AS px, CAST(round((lat + 60) / 0.1) AS BIGINT) + j AS py)) p WHERE px BETWEEN 0 AND 799 AND py BETWEEN 0 AND 1199 GROUP BY 1"""))
def j07_nearest_pixel(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir).select(F.col("group_id").alias("key"), "lat", "lon")
    grid = spark.range(800 * 1200).select((F.col("id") % 800).alias("x"), F.floor(F.col("id") / 800).alias("y"))
    grid = grid.withColumns({"lat": F.col("y") * F.lit(0.1) - 60, "lon": F.col("x") * F.lit(0.1) - 140})
    return joins.nearest_pixel(g, grid, 0.2)


@query("SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem) GROUP BY 1")
def j08_common_days(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return o.join(table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")), "day", "left_semi").groupBy("day").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)")
def j11_unprocessed_days(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return days.join(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")), "day", "left_anti")


@query(with_groups("SELECT ring, count(*) AS n, CAST(sum(energy) AS BIGINT) AS energy FROM (SELECT energy, CASE WHEN dt <= 10 THEN 0 WHEN dt <= 30 THEN 1 WHEN dt <= 1800 THEN 2 END AS ring FROM (SELECT energy, abs(epoch_us(time) - epoch_us((SELECT max(time) FROM g))) / 1e6 AS dt FROM g)) WHERE ring IS NOT NULL GROUP BY ring"))
def j12_rings(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    last = g.agg(F.max("time").alias("t0"))
    return joins.rings(g.crossJoin(F.broadcast(last)), F.col("t0")).groupBy("ring").agg(F.count("*").alias("n"), F.sum("energy").alias("energy"))


@query(with_groups("SELECT group_id FROM (SELECT group_id, row_number() OVER (PARTITION BY satellite ORDER BY time, group_id) AS i FROM g) WHERE i BETWEEN 11 AND 40"))
def o02_file_slice(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    return joins.slice_by_position(g, ["satellite"], ["time", "group_id"], time_cell("time"), 10, 39).select("group_id")


@query("SELECT o_custkey AS custkey FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def o05_except(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey")).subtract(c)


@query("SELECT l_suppkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT l_suppkey FROM lineitem WHERE l_discount > 0.09")
def o06_union_of_flags(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.where("l_quantity > 45").select(F.col("l_suppkey").alias("k")).union(li.where("l_discount > 0.09").select("l_suppkey")).distinct()


@query("SELECT CAST(o_orderdate AS DATE) AS day FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem")
def o07_intersect(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).intersect(table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")))


@query(with_groups("SELECT DISTINCT dataset_file FROM g WHERE energy > 5000"))
def o08_distinct_files(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).where("energy > 5000").select("dataset_file").distinct()


@query(with_groups("SELECT satellite, CAST(floor((lon + 180) / 0.5) AS BIGINT) AS x, CAST(floor((lat + 90) / 0.5) AS BIGINT) AS y, CAST(sum(energy) AS BIGINT) AS energy, count(*) AS n FROM g GROUP BY ALL"))
def a13_energy_raster(spark, sf_dir):
    x, y = F.floor((F.col("lon") + 180) / 0.5), F.floor((F.col("lat") + 90) / 0.5)
    return pe.load_groups(spark, sf_dir).groupBy("satellite", x.alias("x"), y.alias("y")).agg(F.sum("energy").alias("energy"), F.count("*").alias("n"))


@query(with_groups("SELECT CAST(floor(px / 2) AS BIGINT) AS x, CAST(floor(py / 2) AS BIGINT) AS y, CAST(max(e) AS BIGINT) AS energy, round(least(1.0, greatest(0.0, (ln(max(e) + 1.0) - 2) / 10)) * 255, 4) AS level FROM (SELECT floor((lon + 180) / 0.5) AS px, floor((lat + 90) / 0.5) AS py, sum(energy) AS e FROM g GROUP BY 1, 2) GROUP BY 1, 2"))
def m16_image_scale(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    pixels = g.groupBy(F.floor((F.col("lon") + 180) / 0.5).alias("bx"), F.floor((F.col("lat") + 90) / 0.5).alias("by")).agg(F.sum("energy").alias("e"))
    level = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.log(F.max("e") + 1.0) - 2) / 10)) * 255
    return pixels.groupBy(F.floor(F.col("bx") / 2).alias("x"), F.floor(F.col("by") / 2).alias("y")).agg(F.max("e").alias("energy"), F.round(level, 4).alias("level"))


@query(with_groups("SELECT satellite, CAST(hour(time) AS INTEGER) AS hour, count(*) AS n FROM g GROUP BY ALL"))
def a18_hour_of_day(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).groupBy("satellite", F.hour("time").alias("hour")).agg(F.count("*").alias("n"))


@query(with_groups("SELECT satellite, count(DISTINCT CAST(time AS DATE)) AS days FROM g GROUP BY satellite"))
def a16_distinct_days(spark, sf_dir):
    return pe.load_groups(spark, sf_dir).groupBy("satellite").agg(F.countDistinct(F.to_date("time")).alias("days"))


@query(with_groups("SELECT satellite, least(9, CAST(floor(energy * 10.0 / 50000) AS INTEGER)) AS bin, count(*) AS n FROM g GROUP BY ALL"))
def a17_histogram(spark, sf_dir):
    b = F.least(F.lit(9), F.floor(F.col("energy") * 10.0 / 50000).cast("int"))
    return pe.load_groups(spark, sf_dir).groupBy("satellite", b.alias("bin")).agg(F.count("*").alias("n"))


@query(with_groups("SELECT satellite, k, count(*) AS n FROM (SELECT satellite, unnest([u // 1800000000, u // 1800000000 - 1]) AS k, w FROM (SELECT satellite, epoch_us(time) - (SELECT min(epoch_us(time)) FROM g) AS u, (SELECT max(epoch_us(time)) - min(epoch_us(time)) FROM g) AS w FROM g)) WHERE k >= 0 AND k * 1800000000 + 3600000000 <= w GROUP BY satellite, k"))
def w08_sliding_windows(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    return joins.sliding_windows(g, 3600, 1800).groupBy("satellite", "k").agg(F.count("*").alias("n"))


@query(with_groups("""SELECT satellite, min(time) AS first_time, max(time) AS last_time, min(lat) AS lat_lo, max(lat) AS lat_hi, CAST(sum(energy) AS BIGINT) AS energy,
    arg_max(group_id, energy * 10000000 - group_id) AS peak FROM g GROUP BY satellite"""))
def a24_event_summary(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    return g.groupBy("satellite").agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"), F.sum("energy").alias("energy"), F.max_by("group_id", F.col("energy") * 10000000 - F.col("group_id")).alias("peak"))
