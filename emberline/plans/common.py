"""The registry of queries and the SQL that their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberline.session import find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL of the same rows if there is any."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(find_package(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


_SAT = "CASE user_id % 4 WHEN 0 THEN 'G16' WHEN 1 THEN 'G17' WHEN 2 THEN 'G18' ELSE 'G19' END"

#: The point groups of the event stream, as `g`.
GROUPS = f"""g AS (
    SELECT CAST(event_id AS BIGINT) AS group_id, {_SAT} AS satellite,
        {_SAT} || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS dataset_file, CAST(ts AS TIMESTAMP) AS time,
        CAST(((user_id % 6) * 17) % 100 - 50 AS DOUBLE) + CAST((event_id * 7) % 21 - 10 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS lat,
        CASE WHEN user_id % 4 IN (0, 3) THEN CAST(-75 AS DOUBLE) ELSE CAST(-137 AS DOUBLE) END
            + CAST(((user_id * 13) % 3) * 2 AS DOUBLE) + CAST((event_id * 11) % 21 - 10 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS lon,
        CAST(round(value * 100) AS BIGINT) AS energy,
        CASE WHEN event_id % 50 = 0 THEN 1 WHEN event_id % 97 = 0 THEN 5 ELSE 0 END AS quality, event_type
    FROM events)"""


def hav(lat1: str, lon1: str, lat2: str, lon2: str, radius: str = "6371.0") -> str:
    a = f"(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2))"
    return f"(2.0 * {radius} * atan2(sqrt({a}), sqrt(greatest(0.0, 1 - {a}))))"


#: Linkage of the stand-in data: seconds, kilometres and the least size of a cluster.
CLOSENESS_S, CLOSENESS_KM, LEAST_GROUPS = 3600.0, 14.0, 5

_PAIR = hav("x.lat", "x.lon", "y.lat", "y.lon")

#: Cluster members as `m` (cid is the smallest group of a cluster): components of the closeness graph.
MEMBERS = f"""{GROUPS}, k AS (
    SELECT *, epoch_us(time) / 1e6 AS t, CAST(floor(epoch_us(time) / 1e6 / {CLOSENESS_S * 1.5}) AS BIGINT) AS b FROM g WHERE quality = 0 AND energy > 0
), near AS (SELECT *, unnest([b - 1, b, b + 1]) AS nb FROM k), e AS (
    SELECT x.group_id AS u, y.group_id AS v FROM k x JOIN near y ON x.satellite = y.satellite AND x.b = y.nb
    WHERE pow({_PAIR} / {CLOSENESS_KM}, 2) + pow((x.t - y.t) / {CLOSENESS_S}, 2) <= 2
), r AS (SELECT group_id AS a, group_id AS z FROM k UNION SELECT r.a, e.v FROM r JOIN e ON r.z = e.u),
label AS (SELECT a AS group_id, min(z) AS cid, count(*) AS n FROM r GROUP BY a),
m AS (SELECT k.*, cid, n, row_number() OVER (PARTITION BY cid ORDER BY k.time, k.group_id) AS i FROM k JOIN label USING (group_id) WHERE n >= {LEAST_GROUPS})"""


def with_members(body: str) -> str:
    return f"WITH RECURSIVE {MEMBERS} {body}"


def with_groups(body: str) -> str:
    return f"WITH {GROUPS} {body}"
