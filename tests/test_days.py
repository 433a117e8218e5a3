"""Days held back, released once, entered in the ledger, opened again and emptied."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberline.sources import point_events as pe
from emberline.streaming import days, incremental

DAY = date(2024, 3, 5)
T0 = datetime(2024, 3, 5)


def group(k, at, satellite="G16", energy=10, file=None):
    return (k, satellite, file or f"{satellite}_{at:%Y%m%d%H}", at, 1.0, 2.0, energy, 0)


def groups(spark, rows):
    return spark.createDataFrame(rows, pe.GROUP_SCHEMA)


def hours(spark, n, day=T0, satellite="G16", first=0, energy=10):
    return groups(spark, [group(int(f"{day:%m%d}") * 100 + k, day + timedelta(hours=k, minutes=5), satellite, energy) for k in range(first, first + n)])


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


def gate(spark, tmp_path, **options):
    """Runs the gate over all files that are there and returns what has been released so far."""
    stream = days.released_days(incremental.group_stream(spark, str(tmp_path / "in"), 1), expected=24, share=0.95, hold_days=2, keep_days=9, delay="1 hour")
    incremental.to_table(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    return sorted((r.satellite, r.date, r.n_files, r.reason, r.dataset_file) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def put(rows, tmp_path):
    rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_a_day_is_held_and_released_once(rocks, tmp_path):
    put(hours(rocks, 21), tmp_path)
    put(hours(rocks, 3), tmp_path)  # the same files again do not count
    assert gate(rocks, tmp_path) == []
    put(hours(rocks, 2, first=21), tmp_path)
    assert gate(rocks, tmp_path) == [("G16", DAY, 23, "complete", None)]
    put(hours(rocks, 24), tmp_path)  # the last file is late, the others are known
    assert gate(rocks, tmp_path) == [("G16", DAY, 23, "complete", None), ("G16", DAY, 24, "late", "G16_2024030523")]


def test_a_timer_releases_what_stays_incomplete(rocks, tmp_path):
    put(hours(rocks, 4), tmp_path)
    put(groups(rocks, [group(1, T0 + timedelta(days=2)), group(2, T0, satellite=None), (3, "G16", "f", None, 1.0, 2.0, 1, 0)]), tmp_path)
    assert gate(rocks, tmp_path) == []
    put(hours(rocks, 1, day=T0 + timedelta(days=4)), tmp_path)
    put(hours(rocks, 1, day=T0 + timedelta(days=4), first=1), tmp_path)
    assert ("G16", DAY, 4, "timer", None) in gate(rocks, tmp_path)


def test_states_of_days(spark):
    files = hours(spark, 24).unionByName(hours(spark, 5, T0 + timedelta(days=1))).unionByName(hours(spark, 5, T0 - timedelta(days=9))).unionByName(hours(spark, 3, T0 + timedelta(days=2)))
    files = files.withColumnRenamed("time", "start").unionByName(groups(spark, [(9, "G16", "f", None, 1.0, 2.0, 1, 0)]).withColumnRenamed("time", "start"))
    history = spark.createDataFrame([("G17", DAY)], "satellite string, date date")
    state = lambda h: {r.date: r.state for r in days.day_states(files, h, F.lit(DAY + timedelta(days=2)), 24, 0.95, 3).collect()}
    want = {DAY: "ready", DAY + timedelta(days=1): "waiting", DAY - timedelta(days=9): "ready", DAY + timedelta(days=2): "outside"}
    assert state(history) == want
    assert state(history.withColumn("satellite", F.lit("G16"))) == want | {DAY: "processed"}
    assert days.day_states(files.where("false"), history, F.lit(DAY)).count() == 0


def loud(rows):
    """A stand-in for the detection: groups of some energy are detections."""
    return rows.where("energy > 5").select(F.col("group_id").alias("detection_id"), "satellite", "time", "energy")


def store(spark, tmp_path, detect=loud):
    return days.DayStore(spark, str(tmp_path / "days"), detect, expected=24, share=0.95, hold_days=3)


def found(s):
    return sorted(r.detection_id for r in s.detections().collect())


LATER = DAY + timedelta(days=1)


def test_late_rows_wait_for_an_entry(spark, tmp_path):
    s = store(spark, tmp_path)
    assert s.run(hours(spark, 20), "b0", LATER) == []
    assert s.run(hours(spark, 4, first=20), "b1", LATER) == [("G16", DAY)]
    assert len(found(s)) == 24
    late = groups(spark, [group(77, T0 + timedelta(hours=3), file="late"), group(78, T0 + timedelta(hours=4), file="late", energy=1)])
    assert s.run(late, "b2", LATER) == []
    assert 77 not in found(s)
    assert sorted(r.group_id for r in s.late(late).collect()) == [77, 78]
    s.reopen("G16", DAY)
    assert s.run(late.where("false"), "b3", LATER) == [("G16", DAY)]
    assert 77 in found(s) and len(found(s)) == 25
    assert s.run(groups(spark, [group(79, T0, file="later still")]), "b4", LATER) == []
    assert 79 not in found(s)
    assert [r.action for r in s.ledger().orderBy("at").collect()] == ["done", "reopened", "done"]


def test_a_failed_batch_runs_again(spark, tmp_path):
    calls = []

    def breaks(rows):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("an executor is gone")
        return loud(rows)

    s = store(spark, tmp_path, breaks)
    with pytest.raises(RuntimeError):
        s.run(hours(spark, 24), "b0", LATER)
    assert s.ledger().count() == 0
    assert s.run(hours(spark, 24), "b0", LATER) == [("G16", DAY)]
    once = found(s)
    assert s.run(hours(spark, 24), "b0", LATER) == [("G16", DAY)]  # done, but not known to be done
    assert found(s) == once and len(once) == 24
    assert s.ledger().count() == 1 and s.late(hours(spark, 1)).count() == 0


def test_a_day_that_loses_its_detections_is_empty(spark, tmp_path):
    s = store(spark, tmp_path)
    s.run(hours(spark, 24).unionByName(hours(spark, 24, T0 - timedelta(days=1))), "b0", LATER)
    assert len(found(s)) == 48
    s.reopen("G16", DAY)
    s.detect = lambda rows: loud(rows).where(F.to_date("time") != F.lit(DAY))
    assert s.run(hours(spark, 24).where("false"), "b1", LATER) == [("G16", DAY)]
    assert len(found(s)) == 24
    s.reopen("G16", DAY - timedelta(days=1))
    s.detect = lambda rows: loud(rows).where("false")
    s.run(hours(spark, 24).where("false"), "b2", LATER)
    assert found(s) == []


def test_stream_into_the_store(spark, tmp_path):
    put(hours(spark, 24), tmp_path)
    put(hours(spark, 24, T0 + timedelta(days=1), "G17"), tmp_path)
    s = store(spark, tmp_path)
    for _ in range(2):
        s.stream(incremental.group_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "check"), lambda: DAY + timedelta(days=4)).awaitTermination()
    assert len(found(s)) == 48
    assert sorted((r.satellite, r.date) for r in s.ledger().collect()) == [("G16", DAY), ("G17", DAY + timedelta(days=1))]


def test_days_that_vanish_leave_the_store(spark, tmp_path):
    put(hours(spark, 24), tmp_path)
    run = lambda detect: incremental.process_days(incremental.group_stream(spark, str(tmp_path / "in")), detect, str(tmp_path / "store"), str(tmp_path / "check")).awaitTermination()
    run(loud)
    assert spark.read.parquet(str(tmp_path / "store")).count() == 24
    put(hours(spark, 1, T0 + timedelta(days=1)), tmp_path)
    run(lambda rows: loud(rows).where(F.to_date("time") > F.lit(DAY)))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1


def test_judged_arrivals(spark):
    at = lambda h: T0 + timedelta(hours=h)
    files = spark.createDataFrame([("G16", DAY, f"f{h}", at(h)) for h in (1, 2, 3, 5, 7)] + [("G17", DAY, "g", at(1))], "satellite string, date date, file string, arrived timestamp")
    ledger = spark.createDataFrame([("G16", DAY, "done", at(2)), ("G16", DAY, "reopened", at(4)), ("G16", DAY, "done", at(6))], "satellite string, date date, action string, at timestamp")
    assert {r.file: r.late for r in days.judged_arrivals(files, ledger).collect()} == {"f1": False, "f2": True, "f3": True, "f5": False, "f7": True, "g": False}
    assert [(r.satellite, r.at) for r in days.closed_days(ledger).collect()] == [("G16", at(6))]
    assert days.closed_days(ledger.where("action = 'reopened'")).count() == 0
