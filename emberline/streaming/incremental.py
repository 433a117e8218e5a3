"""New files as a stream: sessions, sliding counts, duplicates and day-wise processing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.sources.point_events import GROUP_SCHEMA, extract_store, replace_days
from emberline.sources.scratch import written


def group_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of groups as they arrive."""
    return spark.readStream.schema(GROUP_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def without_repeats(groups: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Groups once, though overlapping files bring them again within the delay."""
    return groups.withWatermark("time", delay).dropDuplicatesWithinWatermark(["dataset_file", "group_id"])


def session_counts(groups: DataFrame, gap: str, delay: str | None = None) -> DataFrame:
    """Runs of groups of a satellite without a gap: start, end, n, energy. A run of a stream
    closes once its watermark passes it: the stream's own, or one made here with `delay`."""
    rows = groups if delay is None else groups.withWatermark("time", delay)
    out = rows.groupBy("satellite", F.session_window("time", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("energy").alias("energy"))
    return out.select("satellite", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "energy")


def sliding_counts(groups: DataFrame, width: str = "1 hour", slide: str = "30 minutes", delay: str | None = None) -> DataFrame:
    rows = groups if delay is None else groups.withWatermark("time", delay)
    out = rows.groupBy("satellite", F.window("time", width, slide).alias("w")).agg(F.count("*").alias("n"))
    return out.select("satellite", F.col("w.start").alias("start"), "n")


def process_days(groups: DataFrame, detect: Callable[[DataFrame], DataFrame], store: str, checkpoint: str, kind: str = "detections"):
    """Adds each batch of new files to the groups kept beside the store (`store`-groups), runs `detect` on all groups of the days it touched and
    the days beside them, and replaces those days' rows. So a day that arrives in several batches is
    whole, clusters go on over midnight, a day whose detections all vanish is emptied, and a batch that is run again
    after a failure gives the same store. Stops when all files that are there are done."""

    kept = f"{store.rstrip('/')}-groups"

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        day = F.to_date("time")
        touched = [r["date"] for r in rows.select(day.alias("date")).distinct().collect() if r["date"]]
        if not touched:
            return
        # days of one batch of files: a short list
        around = lambda n: sorted({d + timedelta(days=k) for d in touched for k in range(-n, n + 1)})
        try:
            before = extract_store(spark, kept, "groups").where(F.col("date").isin(touched)).select(*rows.columns)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            before = rows.where("false")
        replace_days(written(before.unionByName(rows).dropDuplicates(["dataset_file", "group_id"]), "groups"), kept, "groups")
        held = extract_store(spark, kept, "groups").where(F.col("date").isin(around(2))).select(*rows.columns)
        replace_days(written(detect(held).where(day.isin(around(1))), kind), store, kind, {(None, d) for d in around(1)})

    return groups.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_table(rows: DataFrame, path: str, checkpoint: str):
    """Appends closed windows to a table and stops when all files that are there are done."""
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
