"""Commits of detections: one sequence of ids whoever writes, and nothing of what was aborted."""

from datetime import datetime

import pytest

from emberline.sources.detection_store import Conflict, DetectionStore

T0 = datetime(2024, 3, 5, 1, 2, 3)


def rows(spark, n, first=0, satellite="G16"):
    return spark.createDataFrame([(k, satellite, T0, 1.5) for k in range(first, first + n)], "cid long, satellite string, time timestamp, score double")


def ids(store):
    return sorted(r.detection_id for r in store.read().collect())


def add(store, *parts, kind="detections"):
    t = store.begin()
    for p in parts:
        t.add(p, kind)
    return t


def test_commits_go_on_from_each_other(spark, tmp_path):
    store = DetectionStore(spark, str(tmp_path / "s"), wait_s=0.0)
    assert store.read() is None and store.extract("detections") is None and store.begin().commit() == 0
    assert add(store, rows(spark, 2), rows(spark, 1, 2)).commit() == 1
    assert add(store, rows(spark, 2, 3).drop("score"), kind="rejections").commit() == 2
    got = ids(store)
    assert len(got) == 5 and got == list(range(got[0], got[0] + 5)) and got[0] % 1000 == 1
    assert store.extract("rejections").count() == 2 and store.read(1).count() == 3
    wanted = spark.createDataFrame([(got[0],), (got[0],), (5,)], "detection_id long")
    assert [r.detection_id for r in store.extract("detections", wanted).collect()] == [got[0]]
    store.compact()
    assert ids(store) == got and store.version() == 3 and len(store._folders(3)) == 1


def test_an_aborted_write_leaves_nothing(spark, tmp_path):
    store = DetectionStore(spark, str(tmp_path / "s"))
    add(store, rows(spark, 1)).commit()
    t = add(store, rows(spark, 4, 1))
    t.abort()
    assert len(ids(store)) == 1 and not any((tmp_path / "s" / "staged").iterdir()) and len(list((tmp_path / "s" / "rows").iterdir())) == 1
    with pytest.raises(ValueError, match="ended"):
        t.commit()
    with pytest.raises(ValueError, match="not one of"):
        add(store, rows(spark, 1), kind="others")
    with pytest.raises(Exception, match="without satellite"):
        add(store, rows(spark, 1, satellite=None))


class Beaten(DetectionStore):
    """A writer that finds others faster for some tries."""

    def __init__(self, spark, path, others):
        super().__init__(spark, path, tries=3, wait_s=0.0)
        self.others = others

    def _publish(self, version, folders):
        if self.others:
            self.others.pop().commit()
        return super()._publish(version, folders)


def test_two_writers_give_one_sequence(spark, tmp_path):
    path = str(tmp_path / "s")
    other = DetectionStore(spark, path)
    faster = [add(other, rows(spark, 2, 10)), add(other, rows(spark, 3, 20))]
    assert add(Beaten(spark, path, faster), rows(spark, 2)).commit() == 3
    got = ids(other)
    assert len(got) == 7 and got == list(range(got[0], got[0] + 7))
    assert len(list((tmp_path / "s" / "rows").iterdir())) == 3
    with pytest.raises(Conflict):
        add(Beaten(spark, path, [add(other, rows(spark, 1, 30 + k)) for k in range(3)]), rows(spark, 1, 90)).commit()
    assert len(ids(other)) == 10


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from emberline.sources import scratch

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="share"):
        scratch.scratch_folder(Cluster)
    for master in ("local", "local[4]", "local[*]"):
        Cluster.sparkContext.master = master
        assert scratch.scratch_folder(Cluster)
    Cluster.sparkContext.master = "local-cluster[3,2,1024]"
    with pytest.raises(RuntimeError, match="share"):
        scratch.scratch_folder(Cluster)
