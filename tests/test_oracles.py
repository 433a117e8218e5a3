"""Queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from emberline.plans import registry

FOLDER = "/root/testdata/sf0.001"
SOME = ["d17_condense", "f09_stamp", "j05_hotspot_distances", "j11_unprocessed_days", "p05_corridor", "s03_file_neighbours", "s11_asof_files", "st_sessions", "w08_sliding_windows", "a22_density", "j01_truth_match", "o05_except", "m26_pr_curve", "p12_scenes", "c03_c04_heights", "a20_combined_features", "a22_peaks", "s08_layouts", "f18_names_in_order", "w01_chop", "w05_track_deviation"]


def plain(v):
    return round(v, 5) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    cursor = con.execute(registry.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted(tuple(map(plain, r)) for r in cursor.fetchall())
    got = registry.QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(map(plain, r)) for r in got.select(*[f"`{c}`" for c in columns]).collect()) == expected


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
