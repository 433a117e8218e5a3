"""Operators of point events on hand-made rows, and a streaming run against its batch."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.functions import geo, membership, times
from emberline.operators import features, joins, kernels, linkage, profiles, scoring, stereo
from emberline.sources import point_events as pe
from emberline.sources.scratch import written
from emberline.streaming import incremental

T0 = dt.datetime(2024, 3, 1, 12)


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(2)
    rows = [(i, ["G16", "G17"][i % 2], "f", T0 + dt.timedelta(seconds=float(r.integers(0, 900))), float(r.choice([0.0, 5.0]) + r.normal() / 30), float(-75 + r.normal() / 30), int(r.integers(1, 90)), 0) for i in range(160)]
    return spark.createDataFrame(rows, pe.GROUP_SCHEMA)


def test_linkage_equals_union_find(points):
    rows = points.collect()
    parent = {r.group_id: r.group_id for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(rows, 2):
        p, q = math.radians(a.lat), math.radians(b.lat)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b.lon - a.lon) / 2) ** 2
        km = 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
        if a.satellite == b.satellite and (km / 5) ** 2 + ((a.time - b.time).total_seconds() / 20) ** 2 <= 2:
            x, y = find(a.group_id), find(b.group_id)
            parent[max(x, y)] = min(x, y)
    got = {r.group_id: r.cid for r in linkage.single_linkage(points, 5.0, 20.0).collect()}
    assert got == {g: find(g) for g in parent} and len(set(got.values())) > 5


def test_scalars(spark):
    one = spark.range(1).select(
        geo.wrap_lon(F.lit(190.0)).alias("w"), geo.unwrap_lon(F.lit(150.0)).alias("u"), geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        times.stamp(F.lit(T0)).alias("stamp"), times.from_stamp(F.lit("20240611200000")).alias("back"), times.iso_millis(F.lit("2020-03-10T02:23:18.2Z")).alias("iso"),
        membership.membership("group_count", F.lit(25)).alias("m"), membership.membership("mean_spline_residual", F.lit(0.0)).alias("z"),
    ).first()
    assert (one.w, one.u, one.stamp, one.iso, one.m, one.z) == (-170.0, 150.0, "20240611200000", "2020-03-10T02:23:18.200", 0.5, 1.0)
    assert abs(one.half - math.pi * 6371) < 1e-6 and one.back == T0


def test_centroid_of_one_bright_pixel(spark):
    rows = [(1, x, y, float(2 * (x == 4 and y == 5))) for x in range(10) for y in range(10)]
    df = spark.createDataFrame(rows, "cid long, lat int, lon int, energy double")
    c = features.weighted_centroid(df).first()
    assert (c.lat, c.lon) == (4.0, 5.0)


def test_density_finds_four_hot_spots(spark):
    r = np.random.default_rng(123)
    spots = [(10, -50), (30, -65), (-20, -100), (-35, -140)]
    rows = [(float(r.uniform(-45, 45)), float(r.uniform(-150, -20))) for _ in range(1000)] + [(float(a + r.normal() / 4), float(b + r.normal() / 4)) for a, b in spots for _ in range(100)]
    d = kernels.density(spark.createDataFrame(rows, "lat double, lon double"), 0.2, 0.2, 60.0).toPandas()
    for a, b in spots:
        near = d[((d.y + 0.5) * 0.2 - a).abs().lt(5) & ((d.x + 0.5) * 0.2 - b).abs().lt(5)]
        best = near.loc[near.density.idxmax()]
        assert abs((best.y + 0.5) * 0.2 - a) < 0.3 and abs((best.x + 0.5) * 0.2 - b) < 0.3


def test_order_statistics(spark):
    for n in (1, 2, 4, 5, 6, 14, 15):
        rows = [(1, "G16", i, T0 + dt.timedelta(seconds=i), 1.0, 2.0, i + 1) for i in range(n)]
        b = features.basic(spark.createDataFrame(rows, "cid long, satellite string, group_id long, time timestamp, lat double, lon double, energy long")).first()
        at = [r[3] for r in rows]
        assert (b.event_time, b.mid_from, b.mid_to) == (at[n // 2], at[n // 4], at[(-n) // 4]) and b.max_energy == (n if n < 15 else n - 2)


def test_truth_match_codes(spark):
    d = spark.createDataFrame([(1, "G16", 0.0, 0.0, T0, T0), (2, "G16", 20.0, 0.0, T0, T0), (3, "G17", 0.0, 0.0, T0, T0), (4, "G16", 40.0, 0.0, T0, T0)], "cid long, satellite string, lat double, lon double, mid_from timestamp, mid_to timestamp")
    t = spark.createDataFrame([(9, "G16", 0.1, 0.0, True), (7, "G16", 0.0, 0.1, True), (5, "G16", 20.0, 0.0, False)], "idx long, satellite string, lat double, lon double, confident boolean").withColumns({"start": F.lit(T0), "end": F.lit(T0)})
    assert {r.cid: r.truth_idx for r in joins.truth_match(d, t).collect()} == {1: 7, 2: -2, 3: -3, 4: -1}


def test_greedy_alignment_uses_each_time_once(spark):
    left = spark.createDataFrame([(1, 0.0), (1, 0.4), (1, 9.0)], "key long, t double")
    right = spark.createDataFrame([(1, 0.3), (1, 0.9), (1, 20.0)], "key long, t double")
    assert sorted(tuple(r) for r in joins.aligned_pairs(left, right, 1.0).collect()) == [(1, 0.0, 0.3), (1, 0.4, 0.9)]


def test_ids_count_on_from_existing(spark):
    d = spark.createDataFrame([(5, "G16", T0), (6, "G16", T0)], "cid long, satellite string, time timestamp")
    taken = spark.createDataFrame([(16 * 10**14 * 1000 + 20240611200000 * 1000 + 4,)], "detection_id long")
    assert [r.detection_id % 1000 for r in linkage.detection_ids(d, taken).orderBy("cid").collect()] == [5, 6]


def test_precision_recall(spark):
    s = spark.createDataFrame([(0.9, True), (0.8, False), (0.7, True), (0.2, True)], "score double, is_true boolean")
    c = scoring.confusion(s, 0.5).first()
    assert (c.tp, c.fp, c.fn) == (2, 1, 1)
    ap = scoring.average_precision(scoring.curve(s)).first().average_precision
    assert abs(ap - (1 + 2 / 3 + 3 / 4) / 3) < 1e-9
    recalls = [r.recall for r in scoring.sweep(s, 99, 0.0).orderBy("threshold").collect()]
    assert recalls == sorted(recalls, reverse=True)


def test_kernels():
    x = np.arange(20.0)
    assert np.allclose(kernels.smoothed(x**3 - x, 7), x**3 - x)
    assert np.allclose(kernels.pchip(x, 3 * x + 1, np.array([0.5, 7.25])), [2.5, 22.75]) and np.isnan(kernels.pchip(x, x, np.array([-1.0]))[0])


def test_kernel_operators_run(points):
    members = linkage.single_linkage(points, 5.0, 60.0, least=3)
    n = members.count()
    assert kernels.sequential_split(members, 10.0, 60.0).count() == n
    assert kernels.without_outliers(members, least=10).count() <= n
    assert kernels.light_curves(members, 60.0, 8).count() == kernels.stretched_curves(members, 8).count()


def test_stream_gives_what_the_batch_gives(spark, points, tmp_path):
    for k in range(4):
        points.where(F.col("group_id") % 4 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    last = points.limit(1).withColumns({"time": F.lit(T0 + dt.timedelta(days=1)), "group_id": F.lit(999).cast("long")})
    stream = incremental.session_counts(incremental.without_repeats(incremental.group_stream(spark, f"{tmp_path}/in"), "1 hour"), "30 seconds")
    incremental.to_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
    last.write.mode("append").parquet(f"{tmp_path}/in")
    incremental.to_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {tuple(r) for r in incremental.session_counts(points, "30 seconds").collect()}


def test_days_are_replaced_not_added(spark, points, tmp_path):
    for _ in range(2):
        pe.replace_days(points, f"{tmp_path}/store", "detections")
    assert pe.extract_store(spark, f"{tmp_path}/store", "detections").count() == points.count()


def test_a_day_in_two_batches_is_whole(spark, points, tmp_path):
    for k in range(2):
        points.where(F.col("group_id") % 2 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = incremental.group_stream(spark, f"{tmp_path}/in", files_per_trigger=1)
    counts = lambda rows: rows.groupBy("satellite", F.date_trunc("day", "time").alias("time")).agg(F.count("*").alias("n"))
    for _ in range(2):  # the second run has nothing new
        incremental.process_days(stream, counts, f"{tmp_path}/store", f"{tmp_path}/checkpoint").awaitTermination(180)
        got = {tuple(r) for r in pe.extract_store(spark, f"{tmp_path}/store", "detections").select("satellite", "time", "n").collect()}
        assert got == {tuple(r) for r in counts(points).collect()}


def test_chop_takes_the_median_off(spark):
    energy = [10, 11, 10, 12, 40, 10, 11, 10, 41, 10, 11, 10]
    rows = [("G16", 1, i, T0 + dt.timedelta(seconds=i), e) for i, e in enumerate(energy)]
    members = spark.createDataFrame(rows, "satellite string, cid long, group_id long, time timestamp, energy long")
    # 1.4826 times the median distance from the median is 0.74: nothing falls below it
    assert features.chop(members).first().chop == 0


def test_track_deviation_is_in_kilometres(spark):
    track = [(0.0, i / 10, 0.001 * (i % 3)) for i in range(12)]
    rows = [("G16", 1, i, T0 + dt.timedelta(seconds=i), y, x, 1) for i, (_, x, y) in enumerate(track)]
    members = spark.createDataFrame(rows, "satellite string, cid long, group_id long, time timestamp, lat double, lon double, energy long")
    x, y = np.array([t[1] for t in track]), np.array([t[2] for t in track])
    off = np.abs(np.polyval(np.polyfit(x, y, 1), x) - y) * np.pi / 180 * 6371
    norm = np.abs(off - np.median(off)) / np.median(off)
    below = norm <= 5 * 1.4826 * np.median(np.abs(norm - np.median(norm)))
    assert abs(features.track_deviation(members).first().deviation - off[below].max()) < 1e-6


def test_heights_of_points_seen_twice(spark):
    points = spark.createDataFrame([(1, 10.0, -100.0, 35.0), (2, -20.0, -110.0, 0.5), (3, 41.5, -95.0, 120.0)], "group_id long, lat double, lon double, h double")
    (a1, o1), (a2, o2) = (stereo.seen_from(F.col("lat"), F.col("lon"), F.col("h"), s) for s in (-75.2, -137.2))
    seen = points.select("group_id", "h", a1.alias("lat1"), o1.alias("lon1"), a2.alias("lat2"), o2.alias("lon2"))
    rows = stereo.altitudes(seen, -75.2, -137.2).collect()
    assert all(abs(r.alt - r.h) < 1e-3 and r.residual < 1e-3 for r in rows)
    unknown = stereo.altitudes(seen.withColumn("lat1", F.lit(None).cast("double")), -75.2, -137.2).collect()
    assert [r.alt for r in unknown] == [None, None, None]


def test_one_row_an_id(spark):
    ids = spark.createDataFrame([(1,), (2,)], "k long")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    assert sorted(r.v for r in profiles.one_to_one(ids, rows, "k").collect()) == ["a", "b"]
    for bad in (rows.where("k <> 2"), rows.union(rows)):
        with pytest.raises(Exception, match="without exactly one row"):
            profiles.one_to_one(ids, bad, "k").collect()


def test_linkage_across_cells_and_the_date_line(spark):
    rng = np.random.default_rng(5)
    t, lat, lon = rng.uniform(0, 40, 300), rng.uniform(69.5, 70.5, 300), (179.0 + rng.uniform(0, 2, 300) + 180) % 360 - 180
    rows = [(i, "G16", T0 + dt.timedelta(seconds=float(t[i])), float(lat[i]), float(lon[i]), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "group_id long, satellite string, time timestamp, lat double, lon double, energy long")
    p, q = np.radians(lat), np.radians(lon)
    a = np.sin((p[:, None] - p) / 2) ** 2 + np.cos(p[:, None]) * np.cos(p) * np.sin((q[:, None] - q) / 2) ** 2
    km = 2 * 6371.0 * np.arcsin(np.sqrt(a))
    close = (km / 5.0) ** 2 + ((t[:, None] - t) / 2.0) ** 2 <= 2
    label = np.arange(300)
    while True:
        new = np.array([label[close[i]].min() for i in range(300)])
        if (new == label).all():
            break
        label = new
    got = {r.group_id: r.cid for r in linkage.single_linkage(df, 5.0, 2.0).collect()}
    assert [got[i] for i in range(300)] == label.tolist()
    pairs = {(r.u, r.v) for r in linkage.close_pairs(df, 5.0, 2.0).collect()}
    assert pairs == {(i, j) for i in range(300) for j in range(i + 1, 300) if close[i, j]}


def test_linkage_broadcasts_no_rows_dealt_to_cells(spark, points, monkeypatch):
    """What a row is dealt to is not in the estimate of a table's size, so such a side must not be sent to the driver."""
    from emberline.operators import components

    plans = []

    def kept(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return written(df, label)

    monkeypatch.setattr(linkage, "written", kept)
    monkeypatch.setattr(components, "written", kept)
    linkage.single_linkage(points, 5.0, 20.0)
    linkage.radial_linkage(points, 5.0, 20.0)
    plans.append(linkage.close_pairs(points, 5.0, 20.0)._jdf.queryExecution().executedPlan().toString().splitlines())
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    dealt = 0
    for plan in plans:
        dealt += any("Generate" in line for line in plan)
        for i, line in enumerate(plan):
            if "BroadcastExchange" in line:
                below = itertools.takewhile(lambda x, line=line: depth(x) > depth(line), plan[i + 1 :])
                assert not any("Generate" in x for x in below)
    assert dealt >= 3


def test_median_speed_joins_no_pairs(spark, monkeypatch):
    """The median over all pairs of a large cluster, of ranges narrowed by samples, is that of the pairs one by one."""
    from emberline.operators import pairs

    r = np.random.default_rng(4)
    n = [700, 600, 500, 3, 2, 1]
    rows = []
    for cid, k in enumerate(n):
        for i in range(k):
            at = float(r.integers(0, 4)) / 50 if cid == 1 else 0.0 if cid == 2 else float(r.normal()) / 30
            rows.append((cid, 1000 * cid + i, T0 + dt.timedelta(milliseconds=0 if cid == 4 else int(r.integers(0, 900_000))), 5 + at, -75 + at / 2))
    members = spark.createDataFrame(rows, "cid long, group_id long, time timestamp, lat double, lon double")
    want = {}
    for cid, k in enumerate(n):
        one = [x for x in rows if x[0] == cid]
        t, la, lo = np.array([x[2].timestamp() for x in one]), np.radians([x[3] for x in one]), np.radians([x[4] for x in one])
        i, j = np.triu_indices(k, 1)
        h = np.sin((la[i] - la[j]) / 2) ** 2 + np.cos(la[i]) * np.cos(la[j]) * np.sin((lo[i] - lo[j]) / 2) ** 2
        apart = np.abs(t[i] - t[j])
        speed = (2 * 6371.0 * np.arcsin(np.sqrt(h)))[apart > 0] / apart[apart > 0]
        if k > 1:
            want[cid] = np.median(speed) if len(speed) else None
    monkeypatch.setattr(pairs, "LOOKED_AT", 20_000)  # three clusters have more pairs
    monkeypatch.setattr(pairs, "DISTANCES", 20_000)  # and are dealt to blocks
    monkeypatch.setattr(pairs, "LIST", 100)
    for joined in (0, 256):
        got = {x.cid: x.speed for x in features.average_speed(members, joined).collect()}
        assert got.keys() == want.keys() and all(got[c] == pytest.approx(w, rel=1e-6, abs=1e-12) if w is not None else got[c] is None for c, w in want.items())
    at = members.select("cid", "group_id", linkage.seconds(F.col("time")).alias("t"), F.col("lat").alias("x"), F.col("lon").alias("y"), F.lit(0.0).alias("z"), F.lit(1.0).alias("alt"), F.lit(1.0).alias("residual"))
    plain, ranges = ({x.cid: x.speed for x in stereo.medians(at, joined).collect()} for joined in (1000, 0))
    assert plain.keys() == ranges.keys() and all(ranges[c] == pytest.approx(v, rel=1e-9) if v is not None else ranges[c] is None for c, v in plain.items())


def test_rows_repeated_at_a_place_and_time_are_met_once(spark, monkeypatch):
    """A pass over a cluster grows with its unlike rows, whose pairs count as often as the rows are repeated, and the first range is drawn."""
    from emberline.operators import pairs

    r = np.random.default_rng(7)
    unlike = [(cid, int(r.integers(0, 9)) / 300, int(r.integers(0, 9_000_000)), int(r.integers(1, 30))) for cid in (1, 2) for _ in range(120)]
    rows = [(cid, T0 + dt.timedelta(milliseconds=ms), 5 + at) for cid, at, ms, times in unlike for _ in range(times)]
    rows = [(cid, i, time, lat, -75.0) for i, (cid, time, lat) in enumerate(rows)]
    members = spark.createDataFrame(rows, "cid long, group_id long, time timestamp, lat double, lon double")
    want = {}
    for cid in (1, 2):
        t, la = (np.array([f(x) for x in rows if x[0] == cid]) for f in (lambda x: x[2].timestamp(), lambda x: np.radians(x[3])))
        i, j = np.triu_indices(len(t), 1)
        apart = np.abs(t[i] - t[j])
        want[cid] = np.median(6371.0 * np.abs(la[i] - la[j])[apart > 0] / apart[apart > 0])
    kept, written = {}, pairs.written
    monkeypatch.setattr(pairs, "written", lambda df, label: kept.setdefault(label, []).append(written(df, label)) or kept[label][-1])
    for distances, looked in ((pairs.DISTANCES, 1000), (300, 400)):  # the second in blocks and by estimates first
        kept.clear()
        for name, value in (("DISTANCES", distances), ("LOOKED_AT", looked), ("LOOKED_AT_MOST", looked)):
            monkeypatch.setattr(pairs, name, value, raising=False)
        got = {x.cid: x.speed for x in features.average_speed(members).collect()}
        assert got.keys() == want.keys() and all(got[c] == pytest.approx(w, rel=1e-9) for c, w in want.items())
        assert kept["places"][0].agg(F.sum(F.size("times"))).first()[0] == len({x[:3] for x in unlike}) < len(rows) / 10
        assert len(kept["medians"]) > 1 and kept["medians"][0].where("done").count() == 0
        assert kept["medians"][0].where("thin > 1").count() == (2 if looked == 400 else 0)


def test_estimated_counts_of_a_pass_are_near():
    """One row of sixteen tells how many pairs are slower within the spread it gives, and all rows tell it exactly."""
    import pandas as pd

    from emberline.operators import pairs

    r = np.random.default_rng(2)
    lists = [pd.DataFrame({"x": r.random(40) * 9, "y": r.random(40) * 9, "times": [np.sort(r.integers(0, 10**9, 50)) for _ in range(40)], "weights": [r.integers(1, 5, 50) for _ in range(40)]}) for _ in range(2)]
    one, two = (pairs._Side(x, ["x", "y"]) for x in lists)
    distance = lambda here, many: np.hypot(many[0] - here[0], many[1] - here[1])
    at = [x.places[x.at].T[:, :, None] if x is one else x.places[x.at].T[:, None, :] for x in (one, two)]
    apart = np.abs(one.t[:, None] - two.t[None, :]) / 1e6
    speed, w = np.hypot(*(at[1] - at[0])) / apart, one.w[:, None] * two.w[None, :]
    lo, hi = np.quantile(speed, [0.45, 0.55])
    got = []
    for thin in (1, 16):
        counts = {"slower": 0, "inside": 0, "unlike": 0, "spread": 0.0}
        met = list(pairs._counted(one, two, False, lo, hi, 1.0, thin, np.random.default_rng(1), distance, counts))
        got.append((counts, sum(float(k.sum()) for _, k in met)))
    (exact, all_met), (near, _) = got
    assert 0 <= w[speed < lo].sum() - exact["slower"] < 100 and exact["spread"] == 0  # the range is a microsecond wider
    assert exact["inside"] == all_met and 0 <= all_met - w[(speed >= lo) & (speed <= hi)].sum() < 200
    assert near["spread"] > 0 and abs(near["slower"] - exact["slower"]) < 6 * near["spread"] ** 0.5 < 0.05 * w.sum()


def test_a_window_of_many_rows_takes_little_memory():
    """A fifth of a large cluster is a window: a matrix of its square would take 3 GB here."""
    import tracemalloc

    y = np.random.default_rng(3).normal(size=100_000).cumsum()
    tracemalloc.start()
    kernels.smoothed(y, 20_001)
    assert tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()
    flat = np.full(500, 7.3)
    assert (kernels.smoothed(flat, 101) == flat).all()
    for n, window in ((25, 5), (300, 61)):
        got, half, x = kernels.smoothed(y[:n], window), window // 2, np.arange(window)
        want = [np.polynomial.Polynomial.fit(x, y[at : at + window], 3)(i - at) for i in range(n) for at in [min(max(i - half, 0), n - window)]]
        assert np.allclose(got, want)


def test_splits_in_turns_look_at_new_rows_only():
    def plain(t, lat, lon, km, seconds):
        part, n = np.full(len(t), -1), 0
        while (part < 0).any():
            last = int(np.argmax(part < 0))
            part[last] = n
            while len(fit := np.flatnonzero((part < 0) & (kernels._km(lat, lon, lat[last], lon[last]) < km) & (t - t[last] < seconds * 1e6))):
                part[fit], last = n, int(fit[-1])
            n += 1
        return part

    rng = np.random.default_rng(5)
    for n in rng.integers(1, 60, 300):
        t, lat, lon = np.sort(rng.integers(0, 100, n)) * 1_000_000, rng.choice([0.0, 0.05, 0.1, 0.2], n), rng.choice([0.0, 0.05, 0.09], n)
        seconds = float(rng.integers(0, 20))
        assert (kernels.split_in_turns(t, lat, lon, 10.0, seconds) == plain(t, lat, lon, 10.0, seconds)).all()
    seen, km = [], kernels._km
    kernels._km = lambda lat1, *rest: seen.append(len(lat1)) or km(lat1, *rest)
    try:
        assert not kernels.split_in_turns(np.arange(5000) * 1_000_000, np.zeros(5000), np.zeros(5000), 10.0, 20.0).any()
    finally:
        kernels._km = km
    assert sum(seen) < 20_000  # every turn used to look at all rows


def test_duplicates_are_told_apart_by_ids_alone(spark, monkeypatch):
    """Of a cluster no more than its ids is gathered in a row, and no row is dealt by the list of them."""
    from emberline.plans import cluster_queries

    rows = [(1, True, 1, [3, 1, None]), (2, False, 0, [1, None, 3]), (3, False, 0, [1, 3]), (4, False, 2, [3, 1]), (5, True, 5, [13]), (6, False, 0, [])]
    df = spark.createDataFrame([(a, p, o, [(i,) for i in ids]) for a, p, o, ids in rows], "cid long, is_primary boolean, ord int, members array<struct<group_id: long>>")
    assert sorted(r.cid for r in linkage.without_duplicates(df).collect()) == [1, 3, 5, 6]
    met, without = [], linkage.without_duplicates
    monkeypatch.setattr(linkage, "without_duplicates", lambda d: met.append(d) or without(d))
    assert cluster_queries.d10_dedup(spark, "/root/testdata/sf0.001").count() > 0
    assert met[0].schema["members"].dataType.elementType.names == ["group_id"]
