"""Planted hot spots in uniform noise, and peaks by cut and by exact weights."""

import math
import random

import numpy as np

from emberline.operators import hotspots

SPOTS = [(10.0, -50.0), (30.0, -65.0), (-20.0, -100.0), (-35.0, -140.0)]


def cloud():
    r = np.random.default_rng(123)
    noise = np.stack([r.uniform(-45, 45, 1000), r.uniform(-150, -20, 1000)], axis=1)
    return np.concatenate([noise, *[r.normal(s, 0.5, (100, 2)) for s in SPOTS]])


def test_planted_spots_are_found(spark):
    points = cloud()
    df = spark.createDataFrame([*map(tuple, points.tolist()), (None, 1.0), (1.0, None)], "lat double, lon double").repartition(3)
    for cut in (3.0, None):
        got = hotspots.hot_spots(df, 1.0, 1.0, 60.0, cut=cut, n=4, max_km=300.0, ring_km=20.0, rounds=6).collect()
        assert len(got) == 4
        for lat, lon in SPOTS:
            assert min(max(abs(r.lat - lat), abs(r.lon - lon)) for r in got) < 0.2
        assert all(40 <= r.radius_km <= 300 for r in got)
    assert hotspots.hot_spots(df.where("false")).count() == 0


def test_a_peak_over_the_antimeridian(spark):
    r = random.Random(1)
    rows = [(r.gauss(5, 0.2), (r.gauss(180, 0.2) + 180) % 360 - 180) for _ in range(300)] + [(r.uniform(-60, 60), r.uniform(-180, 180)) for _ in range(100)]
    best = hotspots.peak_places(spark.createDataFrame(rows, "lat double, lon double"), 1.0, 1.0, 60.0, rounds=6).where("peak = 1").first()
    assert abs(best.lat - 5) < 0.1 and abs(abs(best.lon) - 180) < 0.1


def test_shift_is_the_weighted_mean(spark):
    r = random.Random(2)
    rows = [(r.uniform(-2, 2), r.uniform(8, 12)) for _ in range(80)]
    one = hotspots.shifted(spark.createDataFrame(rows, "lat double, lon double"), spark.createDataFrame([(1, 0.3, 9.7)], "peak long, plat double, plon double"), 150.0, None).first()
    w = np.array([math.exp(-(hotspots._km(0.3, 9.7, a, b) ** 2) / (2 * 150.0**2)) for a, b in rows])
    p, q = np.radians(np.array(rows)).T
    x, y, z = (float((w * v).sum()) for v in (np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)))
    assert abs(one.plat - math.degrees(math.atan2(z, math.hypot(x, y)))) < 1e-9 and abs(one.plon - math.degrees(math.atan2(y, x))) < 1e-9 and abs(one.density - w.sum()) < 1e-9


def test_reference_of_the_globe(spark):
    got = {r.y: r.reference for r in hotspots.grid_reference(spark, 2.0, 200.0, cut=None).collect()}
    assert len(got) == 90
    near = 2 * math.pi * 200.0**2 / 111.19**2
    assert abs(got[0] / near - 1) < 0.01 and got[40] > 5 * got[0]
