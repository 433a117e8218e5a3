"""Suppression found by the simplex, exact samples, and classifiers that are stored."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberline.functions.times import valid_id
from emberline.operators import classifier, profiles, sampling, scan, tuning


def planted(spark):
    """False rows of high score within 30 km of the first spot, true ones elsewhere, and a background of both."""
    r = random.Random(6)
    rows = [(r.uniform(0.6, 0.8), False, [r.uniform(1, 30), r.uniform(500, 900)]) for _ in range(400)]
    rows += [(r.uniform(0.5, 0.9), True, [r.uniform(33, 95), r.uniform(500, 900)]) for _ in range(300)]
    rows += [(r.uniform(0.0, 1.0), r.random() < 0.5, [r.uniform(200, 900), r.uniform(20, 900)]) for _ in range(400)]
    rows += [(None, True, [1.0, 1.0]), (0.5, None, [1.0, 1.0]), (0.4, False, [None, 5.0])]
    return rows, spark.createDataFrame(rows, "score double, is_true boolean, distances array<double>").repartition(3)


def brute_ratio(rows, radii, strengths, target):
    scores = []
    for s, y, d in rows:
        if s is None or y is None:
            continue
        s = round(round(s / 0.001) * 0.001, 9)
        fall = next((a for x, r, a in zip(d, radii, strengths, strict=True) if x is not None and -(-round(x / 0.1, 6) // 1) * 0.1 <= r + 1e-9), 0.0)
        scores.append((round(min(1.0, max(0.0, s - fall)), 6), y))
    cut = min({s for s, _ in scores}, key=lambda s: (round(abs(s - target), 9), -s))
    true, false = [s for s, y in scores if y], [s for s, y in scores if not y]
    tpr, fpr = sum(s >= cut for s in true) / len(true), sum(s >= cut for s in false) / len(false)
    return cut, tpr, fpr, tpr / max(fpr, 0.5 / len(false))


def test_ratios_and_the_simplex(spark):
    rows, df = planted(spark)
    points = [([30.0, 1.0], [0.5, 0.1]), ([12.3, 40.0], [0.2, 0.9]), ([100.0, 100.0], [1.0, 1.0]), ([-1.0, -1.0], [0.0, 0.0])]
    got = {r.point: (r.threshold, r.tpr, r.fpr, r.ratio) for r in tuning.likelihood_ratios(tuning.suppression_histogram(df, 2), points).collect()}
    for i, (r, a) in enumerate(points):
        assert got[i] == pytest.approx(brute_ratio(rows, r, a, 0.5))
    assert tuning.suppression_histogram(df, 2).agg(F.sum(F.col("t") + F.col("f"))).first()[0] == len(rows) - 2
    found = tuning.optimise_suppression(df, 2, rounds=40)
    assert 28 <= found.radii[0] <= 40 and found.strengths[0] > 0.15
    assert found.ratio > 1.3 * found.before
    assert found.ratio == pytest.approx(brute_ratio(rows, found.radii, found.strengths, 0.5)[3])


def keyed(spark, n):
    r = random.Random(n)
    rows = [(k, r.choice([True, False, False, False, None]), r.choice([0.0, 1.0, 2.5, None, -1.0])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "k long, yes boolean, w double").repartition(4)


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_exact_splits(spark, n):
    _, df = keyed(spark, n)
    parts = {r.k: r.part for r in sampling.split(df, "k", {"train": 0.7, "val": 0.15, "test": 0.15}, seed=4).collect()}
    sizes = Counter(parts.values())
    assert (sizes["train"], sizes["val"]) == (int(n * 0.7), int(n * 0.15)) and len(parts) == n
    assert {r.k: r.part for r in sampling.split(df.repartition(2), "k", {"train": 0.7, "val": 0.15, "test": 0.15}, seed=4).collect()} == parts
    order = {r.k: r.o for r in df.select("k", F.xxhash64(F.lit(4), "k").alias("o")).collect()}
    assert all(parts[k] == "train" for k in sorted(order, key=order.get)[: int(n * 0.7)])


def test_exact_balance(spark):
    rows, df = keyed(spark, 300)
    p = sum(1 for _, y, _ in rows if y)
    for ratio in (0.25, 0.4, 0.9, 1.0):
        got = sampling.rebalanced(df, F.col("yes"), ratio, "k", seed=2).collect()
        assert sum(1 for r in got if r.yes) == p
        assert sum(1 for r in got if not r.yes) == min(len(rows) - p, round(p / ratio) - p)
        assert len({r.k for r in got}) == len(got)


def test_weighted_draws(spark):
    rows, df = keyed(spark, 200)
    total = sum(max(w or 0, 0) for *_, w in rows)
    for n in (1, 50, 1000):
        got = sampling.drawn(df, "w", n, "k", seed=n).collect()
        assert sorted(r.draw for r in got) == list(range(n)) or (len(got) == n and len({r.draw for r in got}) == n)
        times = Counter(r.k for r in got)
        assert all(abs(times[k] - n * max(w or 0, 0) / total) < 1 + 1e-6 for k, _, w in rows)
    assert sampling.drawn(df.where("w <= 0 OR w IS NULL"), "w", 5, "k").count() == 0
    assert sampling.drawn(df, "w", 0, "k").count() == 0
    with pytest.raises(ValueError, match="cells"):
        sampling.drawn(df, "w", 5, "k", order=F.col("k"))
    assert sampling.drawn(df, "w", 9, "k", order=F.col("k"), cell=F.floor(F.col("k") / 10)).count() == 9
    assert scan.scanned(df, [], ["k"], F.floor(F.col("k") / 10), sums={"i": F.lit(1)}).where("i <> k + 1").count() == 0


def test_a_stored_classifier(spark, tmp_path):
    r = random.Random(1)
    rows = [(k, r.gauss(3 * (k % 2), 1), None if k % 17 == 0 else float(r.randrange(9)), float("nan") if k % 23 == 0 else r.random(), [0.9, 0.1, None][k % 2 if k % 7 else 2]) for k in range(300)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, belief double")
    matrix = classifier.feature_matrix(df, ["a", "b", "c"], "belief")
    assert matrix.where("belief IS NULL AND label <> 0").count() == 0 and matrix.where("isnan(c)").count() == 0
    model = classifier.fit(matrix.where("k < 200"), {"a": "standard", "b": "minmax", "c": "robust"}, trees=5)
    classifier.save(model, str(tmp_path / "model"))
    before = {x.k: x.score for x in classifier.scored(model, matrix).collect()}
    again = classifier.load(str(tmp_path / "model"))
    assert {x.k: x.score for x in classifier.scored(again, classifier.feature_matrix(df, ["a", "b", "c"])).collect()} == before
    high, low = ([before[k] for k in range(200, 300) if k % 2 == side] for side in (0, 1))
    assert sum(high) / len(high) > sum(low) / len(low) + 0.2


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_a_forest_of_one_label(spark, tmp_path, label):
    """Without any truth match in the part it learns from a forest knows one label: the probability of label 1 is 0 then, not an error."""
    df = spark.createDataFrame([(k, float(k % 5), label) for k in range(30)], "k long, a double, belief double")
    matrix = classifier.feature_matrix(df, ["a"], "belief")
    model = classifier.fit(matrix, {"a": "standard"}, trees=3)
    classifier.save(model, str(tmp_path / "model"))
    for one in (model, classifier.load(str(tmp_path / "model"))):
        assert {r.score for r in classifier.scored(one, matrix).collect()} == {label} and classifier.scored(one, matrix).count() == 30


@pytest.mark.parametrize("n", [0, 8, 24])
def test_scores_of_few_clusters(spark, tmp_path, n):
    """Clusters that are too few for a training part, or none of which is a truth event, are still all of the result."""
    from emberline.plans import learning_queries

    rows = [(21 * k, dt.datetime(2024, 1, 1 + k // 8, 12, k % 8), k // 8, 5.0 + k) for k in range(n)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double")
    events.withColumn("event_type", F.lit("view")).write.parquet(str(tmp_path / "events.parquet"))
    got = learning_queries.m06_forest_scores(spark, str(tmp_path)).collect()
    assert len(got) == n // 8 and len({r.cid for r in got}) == n // 8
    assert all(r.score == 0.0 if n == 24 else r.score is None for r in got)


def test_assessment(spark):
    rows = [(1, 0.95, 0.0, 3), (2, 0.95, 0.5, 3), (3, 1.7, 0.0, 3), (4, 0.1, 0.6, 3), (5, None, 0.0, 3), (6, 0.1, 0.0, 30), (7, None, 0.0, 30)]
    df = spark.createDataFrame(rows, "k long, score double, fall double, size int")
    got = {r.k: (r.score, r.triage, r.validation) for r in classifier.assessed(df, F.col("fall"), F.col("size"), 15, 0.4, 0.4, 0.9).collect()}
    assert got[1] == (0.95, "accepted", "accepted") and got[2][1:] == ("accepted", "candidate") and got[3][0] == 1.0 and got[4] == (0.0, "rejected", "rejected")
    assert got[5] == (None, "N/A", "N/A") and got[6][1:] == ("accepted", "candidate") and got[7][1:] == ("accepted", "candidate")


def test_profiles_of_one_truth(spark):
    rows = [(1, 7, 5, 0.1), (2, 7, 4, 0.9), (3, -1, 3, 0.5), (4, 8, 2, 0.4), (5, 7, 1, 0.2), (6, None, 9, None), (7, -3, 1, 0.3)]
    df = spark.createDataFrame(rows, "cid long, truth_idx long, n_groups long, score double")
    got = {r.cid: tuple(r)[1:] for r in profiles.combined_by_match(df).collect()}
    assert got == {1: (7, 10, 0.9, 3), 2: (-99, 4, 0.9, 1), 3: (-1, 3, 0.5, 1), 4: (8, 2, 0.4, 1), 5: (-99, 1, 0.2, 1), 6: (None, 9, None, 1), 7: (-3, 1, 0.3, 1)}
    assert profiles.combined_by_match(df.where("false")).count() == 0


def test_valid_ids(spark):
    texts = [("1620240101000000001", True), ("4294967295", False), ("4294967296", True), ("-5", True), ("12", False), ("x1", False), ("99999999999999999999", False), (None, False), ("", False)]
    df = spark.createDataFrame([(t,) for t, _ in texts], "id string")
    assert [r.v for r in df.select(valid_id(F.col("id")).alias("v")).collect()] == [v for _, v in texts]
