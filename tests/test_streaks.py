"""Edges, segments and planes of time against dense arrays and one cluster at a time."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from emberline.operators import streaks

T0 = datetime(2024, 3, 5)


def pixel_frame(spark, images):
    rows = [(k, x, y, "more") for k, image in images.items() for x, y in image]
    return spark.createDataFrame(rows, "k long, x long, y long, angle string").repartition(2)


def brute_edges(image, size):
    along, across = (np.array(v) for v in streaks.gradient_weights(1.0))
    gx, gy, half = np.zeros((size, size)), np.zeros((size, size)), len(along) // 2
    for x, y in image:
        for i, a in enumerate(along):
            for j, b in enumerate(across):
                if 0 <= x + i - half < size and 0 <= y + j - half < size:
                    gx[x + i - half, y + j - half] += a * b
                if 0 <= x + j - half < size and 0 <= y + i - half < size:
                    gy[x + j - half, y + i - half] += a * b
    gx, gy = gx.round(6), gy.round(6)
    m = np.sqrt(gx * gx + gy * gy).round(6)
    thin = set()
    for x in range(1, size - 1):
        for y in range(1, size - 1):
            if m[x, y] >= streaks.WEAK:
                flat = math.tan(math.pi / 8)
                dx = 0 if abs(gx[x, y]) < flat * abs(gy[x, y]) else 1
                dy = 0 if abs(gy[x, y]) < flat * abs(gx[x, y]) else 1 if gx[x, y] * gy[x, y] >= 0 or dx == 0 else -1
                if m[x, y] > m[x - dx, y - dy] and m[x, y] >= m[x + dx, y + dy]:
                    thin.add((x, y))
    strong = [p for p in thin if m[p] >= streaks.STRONG]
    seen = set(strong)
    while strong:
        x, y = strong.pop()
        for p in ((x + a, y + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
            if p in thin and p not in seen:
                seen.add(p)
                strong.append(p)
    return {(*map(int, p), round(float(m[p]), 4)) for p in seen}


def test_edges(spark):
    r = random.Random(4)
    images = {0: {(x, 2 * x // 3 + 4) for x in range(3, 25)}, 1: {(r.randrange(28), r.randrange(28)) for _ in range(40)}, 2: {(5, 5)}, 3: {(x, y) for x in range(8, 20) for y in range(8, 20)}, 7: {(0, 0), (27, 27)}}
    got = {}
    for row in streaks.edge_pixels(pixel_frame(spark, images), "k", 28, 28).collect():
        got.setdefault(row.k, set()).add((row.x, row.y, round(row.strength, 4)))
    assert got == {k: e for k, image in images.items() if (e := brute_edges(image, 28))}
    assert streaks.edge_pixels(pixel_frame(spark, {0: set()}), "k", 28, 28).count() == 0


def brute_segments(image, angles, step, threshold, length, gap):
    vote = lambda x, y, a: math.floor(round((x * math.cos(a * math.pi / angles) + y * math.sin(a * math.pi / angles)) / step, 6))
    votes = Counter((a, vote(x, y, a)) for x, y in image for a in range(angles))
    votes = {k: n for k, n in votes.items() if n >= threshold}
    beaten = lambda a, r, n: any(((p, q) != (a, r)) and (votes.get((p, q), 0) > n or (votes.get((p, q), 0) == n and (p, q) < (a, r))) for p in (a - 1, a, a + 1) for q in (r - 1, r, r + 1))
    peaks = {(a, r): n for (a, r), n in votes.items() if not beaten(a, r, n)}
    lines = {}
    for x, y in image:
        own = sorted((-peaks[(a, vote(x, y, a))], a, vote(x, y, a)) for a in range(angles) if (a, vote(x, y, a)) in peaks)
        if own:
            _, a, r = own[0]
            lines.setdefault((a, r), []).append((round(y * math.cos(a * math.pi / angles) - x * math.sin(a * math.pi / angles), 6), y, x))
    out = set()
    for (a, r), points in lines.items():
        points.sort()
        parts = [[points[0]]]
        for before, p in zip(points, points[1:], strict=False):
            if p[0] - before[0] > gap:
                parts.append([])
            parts[-1].append(p)
        for n, part in enumerate(parts, 1):
            if round(part[-1][0] - part[0][0], 4) >= length:
                out.add((a, r, n, len(part), round(part[-1][0] - part[0][0], 4), part[0][2], part[0][1], part[-1][2], part[-1][1]))
    return out


def test_segments(spark):
    r = random.Random(8)
    images = {
        1: {(x, x) for x in range(30)} | {(x, 40) for x in range(0, 12)} | {(x, 40) for x in range(30, 45)} | {(r.randrange(50), r.randrange(50)) for _ in range(60)},
        2: {(7, y) for y in range(5, 40)} | {(x, 50 - x) for x in range(10, 45)},
        3: {(1, 1)},
    }
    found, pixels = streaks.segments(pixel_frame(spark, images).drop("angle"), "k", 36, 1.0, 8, 9.0, 5.0)
    got = {}
    for row in found.collect():
        got.setdefault(row.k, set()).add((row.angle, row.rho, row.segment, row.n_pixels, row.length, row.x0, row.y0, row.x1, row.y1))
    want = {k: s for k, image in images.items() if (s := brute_segments(image, 36, 1.0, 8, 9.0, 5.0))}
    assert got == want and len(want[1]) >= 3
    assert pixels.count() == sum(s[3] for each in want.values() for s in each)


def test_planes_of_time(spark):
    r = random.Random(2)
    rows = []
    for k in range(40):  # a streak with some groups out of time
        rows.append((1, k, T0 + timedelta(minutes=k if k % 8 else 700 - k), 10 + 0.1 * k + r.uniform(-0.001, 0.001), 20 + 0.05 * k + r.uniform(-0.001, 0.001)))
    rows += [(2, k, T0 + timedelta(minutes=r.randrange(999)), r.uniform(0, 1), r.uniform(0, 1)) for k in range(30)]
    rows += [(3, k, T0 + timedelta(minutes=k), 1.0, 1.0) for k in range(9)] + [(4, 0, T0, 1.0, 2.0), (4, 1, T0, 1.0, 2.0), (5, 1, None, None, None)]
    df = spark.createDataFrame(rows, "cid long, group_id long, time timestamp, lat double, lon double").withColumn("n", F.lit(7)).repartition(3)
    got = {x.cid: x for x in streaks.consensus_lines(df, 60, width=2.0).collect()}
    assert set(got) == {1, 2}
    assert 30 <= got[1].n_inliers <= 35 and got[1].r2 > 0.99 and got[1].n == 40
    assert got[2].r2 is None or got[2].n_inliers < 20
    mine = [x for x in rows if x[0] == 1 and x[1] % 8]
    a = np.array([[x[4] - 20, x[3] - 10, 1] for x in mine])
    slopes = np.linalg.lstsq(a, np.array([(x[2] - T0).total_seconds() / 60 for x in mine]), rcond=None)[0]
    if got[1].n_inliers == len(mine):
        assert np.allclose([got[1].slope_lon, got[1].slope_lat], slopes[:2], rtol=1e-3, atol=1e-2)
    assert {x.cid for x in streaks.consensus_lines(df, 60, least_r2=0.99, width=2.0).collect() if x.n_inliers > 9} == {1}
    assert streaks.consensus_lines(df.where("false")).count() == 0


def test_a_streak_is_found(spark):
    r = random.Random(5)
    line = [(k, T0 + timedelta(seconds=10 * k), 10 + 0.02 * k, 30 + 0.03 * k, 0) for k in range(300)]
    noise = [(1000 + k, T0 + timedelta(seconds=r.randrange(3600)), r.uniform(9, 17), r.uniform(29, 40), 0) for k in range(60)]
    df = spark.createDataFrame(line + noise, "group_id long, time timestamp, lat double, lon double, k long").repartition(2)
    held, found = streaks.streaks(df, "k", 200, 200, trials=60, least_r2=0.9, threshold=20, line_length=60.0, line_gap=10.0)
    ids = {x.group_id for x in held.collect()}
    assert found.count() >= 1 and min(x.r2 for x in found.collect()) >= 0.9
    assert len([k for k in ids if k < 1000]) > 30 and len([k for k in ids if k >= 1000]) <= 5
