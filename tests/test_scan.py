"""Running values over cells against one pass over each key."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberline.operators import joins, linkage, scan
from emberline.operators.components import components

T0 = datetime(2024, 3, 5)


def rows_of(spark, seed, n, span):
    r = random.Random(seed)
    rows = [(k, r.choice(["a", "b", None]), None if r.random() < 0.05 else T0 + timedelta(seconds=r.randrange(span)), r.choice([None, 1, 2, 5])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "k long, key string, time timestamp, value long").repartition(3)


@pytest.mark.parametrize(("n", "span", "cell"), [(200, 4000, 10), (150, 50, 7), (60, 10**6, 3), (1, 5, 5), (120, 3, 1000)])
def test_scans(spark, n, span, cell):
    rows, df = rows_of(spark, n, n, span)
    got = scan.scanned(df, ["key"], ["time", "k"], scan.time_cell("time", cell), {"total": F.col("value"), "rank": F.lit(1)}, {"last": F.col("value")}, {"following": F.col("k")})
    got = {r.k: (r.total, r["rank"], r["last"], r.following, r.value) for r in got.collect()}
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append(row)
    want = {}
    for group in by.values():
        group.sort(key=lambda x: (x[2] is not None, x[2] or T0, x[0]))
        total = 0
        for i, (k, _, _, value) in enumerate(group):
            total += value or 0
            want[k] = (total, i + 1, next((x[3] for x in reversed(group[:i]) if x[3] is not None), None), group[i + 1][0] if i + 1 < len(group) else None, value)
    assert got == want
    assert scan.scanned(df.where("false"), ["key"], ["time", "k"], scan.time_cell("time", cell), {"total": F.col("value")}).count() == 0


def test_runs_go_on_over_cells(spark):
    rows = [(k, "s", T0 + timedelta(seconds=s), 10) for k, s in enumerate([0, 1, 2, 3, 4, 5, 6, 7, 30, 31, 90, 91, 92])]
    df = spark.createDataFrame(rows, "group_id long, satellite string, time timestamp, energy long")
    for cell in (1.0, 3.0, 1000.0):
        got = sorted((r.run, r.n, r.energy) for r in linkage.condensed(df, "satellite", 5.0, cell).collect())
        assert got == [(1, 8, 80), (2, 2, 20), (3, 3, 30)]


def test_slices(spark):
    rows = [(k, "ab"[k % 2], T0 + timedelta(hours=k)) for k in range(20)]
    df = spark.createDataFrame(rows, "k long, key string, time timestamp")
    cut = lambda a, b: sorted(r.k for r in joins.slice_by_position(df, ["key"], ["time", "k"], scan.time_cell("time", 3600.0), a, b).collect())
    assert cut(0, 1) == [0, 1, 2, 3]
    assert cut(8, -1) == [16, 17, 18, 19] == cut(8, None)
    assert cut(7, -2) == [14, 15, 16, 17]
    assert cut(3, 2) == []


def test_files_before_and_after(spark):
    at = lambda h: T0 + timedelta(hours=h)
    left = spark.createDataFrame([("s", at(0), 1), ("s", at(5), 2), ("s", at(9), 3), ("t", at(1), 4)], "satellite string, time timestamp, key long")
    right = spark.createDataFrame([("s", at(5), "x"), ("s", at(8), "y")], "satellite string, time timestamp, name string")
    got = {r.key: (r.before, r.after) for r in joins.asof_neighbours(left, right, "satellite").collect()}
    assert got == {1: (None, "x"), 2: ("x", "y"), 3: ("y", None), 4: (None, None)}


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components_in_rounds_and_in_one_task(spark, one_task):
    r = random.Random(3)
    pairs = [(r.randrange(400) * 7, r.randrange(400) * 7) for _ in range(300)] + [(k, k + 1) for k in range(10_000, 10_200)] + [(5, 5), (20_000, 20_000 + 3), (20_003, 20_000)] + [(30_000, k) for k in range(30_001, 30_100)]
    near = defaultdict(set)
    for u, v in pairs:
        if u != v:
            near[u].add(v)
            near[v].add(u)
    want = {}
    for node in sorted(near):
        todo = [node] if node not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = node
                todo += near[x]
    df = spark.createDataFrame(pairs, "u long, v long").repartition(3)
    assert {r.node: r.component for r in components(df, one_task).collect()} == want
    assert components(df.where("u = v"), one_task).count() == 0
