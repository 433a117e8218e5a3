"""Queries of days as the unit of work: which are complete, which files came too late."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from emberline.sources import point_events as pe
from emberline.streaming import days

from .common import GROUPS, query

#: Hourly files of the stand-in events: a day of a satellite has 24.
_HOURS = f"{GROUPS}, h AS (SELECT satellite, CAST(time AS DATE) AS date, date_trunc('hour', time) AS file, min(time) AS start, max(time) AS stop, count(*) AS n, CAST(sum(energy) AS BIGINT) AS energy FROM g GROUP BY ALL), d AS (SELECT satellite, date, count(*) AS n_files, CAST(sum(energy) AS BIGINT) AS energy FROM h GROUP BY ALL)"


def _hours(spark, sf_dir):
    g = pe.load_groups(spark, sf_dir)
    hour = F.date_trunc("hour", "time")
    return g.groupBy("satellite", F.to_date("time").alias("date"), F.concat_ws("_", "satellite", hour.cast("string")).alias("dataset_file")).agg(
        F.min("time").alias("start"), F.max("time").alias("stop"), F.count("*").alias("n"), F.sum("energy").alias("energy")
    )


@query(f"""WITH {_HOURS} SELECT satellite, date, n_files, CASE WHEN energy % 4 = 0 THEN 'processed' WHEN date >= (SELECT max(date) FROM d) OR date < DATE '2024-01-03' THEN 'outside'
    WHEN date > (SELECT max(date) FROM d) - 20 AND n_files < 23 THEN 'waiting' ELSE 'ready' END AS state FROM d""")
def st3_complete_days(spark, sf_dir):
    files = _hours(spark, sf_dir)
    history = files.groupBy("satellite", "date").agg(F.sum("energy").alias("energy")).where("energy % 4 = 0")
    today = files.agg(F.max("date").alias("today")).first()["today"]
    return days.day_states(files, history, F.lit(today), expected=24, share=0.97, hold_days=20, first=date(2024, 1, 3))


@query(f"""WITH {_HOURS}, f AS (SELECT *, stop + to_hours(CAST(8 * (n % 5) AS INTEGER)) AS arrived FROM h),
    e AS (SELECT satellite, date, CAST(date AS TIMESTAMP) + INTERVAL 36 HOUR AS at, true AS closed FROM d
        UNION ALL SELECT satellite, date, CAST(date AS TIMESTAMP) + INTERVAL 40 HOUR, false FROM d WHERE energy % 3 = 0
        UNION ALL SELECT satellite, date, CAST(date AS TIMESTAMP) + INTERVAL 46 HOUR, true FROM d WHERE energy % 2 = 0),
    j AS (SELECT f.satellite, f.date, f.file, f.energy, coalesce(arg_max(e.closed, e.at), false) AS late FROM f LEFT JOIN e ON f.satellite = e.satellite AND f.date = e.date AND e.at <= f.arrived GROUP BY ALL)
    SELECT satellite, date, count(*) AS n_files, count(*) FILTER (late) AS n_late, CAST(coalesce(sum(energy) FILTER (late), 0) AS BIGINT) AS late_energy FROM j GROUP BY satellite, date""")
def st5_late_files(spark, sf_dir):
    """Files that came after their day was closed, by a ledger in which some days are opened again and some of those done again."""
    files = _hours(spark, sf_dir).withColumn("arrived", F.col("stop") + F.make_interval(hours=(F.col("n") % 5 * 8).cast("int")))
    day = files.groupBy("satellite", "date").agg(F.sum("energy").alias("energy"))
    at = lambda hours: F.col("date").cast("timestamp") + F.make_interval(hours=F.lit(hours))
    entry = lambda rows, action, hours: rows.select("satellite", "date", F.lit(action).alias("action"), at(hours).alias("at"))
    ledger = entry(day, "done", 36).unionByName(entry(day.where("energy % 3 = 0"), "reopened", 40)).unionByName(entry(day.where("energy % 2 = 0"), "done", 46))
    judged = days.judged_arrivals(files, ledger)
    return judged.groupBy("satellite", "date").agg(F.count("*").alias("n_files"), F.count_if("late").alias("n_late"), F.sum(F.when(F.col("late"), F.col("energy")).otherwise(0)).alias("late_energy"))
