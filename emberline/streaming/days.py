"""Days as the unit of work: held back until their files are there, done once, late rows set aside, all of it in a ledger."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from emberline.session import find_package
from emberline.sources.point_events import replace_days
from emberline.sources.scratch import written

#: Files that make up a day (one every five minutes) and the share of them that must be there.
FILES_A_DAY, SHARE = 288, 0.95


def least_files(expected: int = FILES_A_DAY, share: float = SHARE) -> int:
    return int(expected * share)


def day_states(files: DataFrame, history: DataFrame, today: Column, expected: int = FILES_A_DAY, share: float = SHARE, hold_days: int = 0, first: date | None = None, last: date | None = None, skip_today: bool = True) -> DataFrame:
    """satellite, date, n_files, state of every day with files: `processed` if history has it, `outside` the dates asked for or the
    current day, `waiting` if it is one of the latest `hold_days` days and lacks files, else `ready`.

    files: satellite, dataset_file, start. history: satellite, date. today: the current date. Files with a null start have no day.
    """
    date_ = F.to_date("start")
    days = files.where(date_.isNotNull()).groupBy("satellite", date_.alias("date")).agg(F.countDistinct("dataset_file").alias("n_files"))
    done = history.select("satellite", "date").distinct().withColumn("done", F.lit(True))
    outside = F.lit(False)
    if skip_today:
        outside = outside | (F.col("date") >= today)
    if first:
        outside = outside | (F.col("date") < F.lit(first))
    if last:
        outside = outside | (F.col("date") > F.lit(last))
    held = (F.col("date") > F.date_sub(today, hold_days)) & (F.col("n_files") < least_files(expected, share))
    state = F.when(F.col("done"), "processed").when(outside, "outside").when(held, "waiting").otherwise("ready")
    return days.join(done, ["satellite", "date"], "left").select("satellite", "date", "n_files", state.alias("state"))


class DayGate(StatefulProcessor):
    """State of one satellite's day: files seen, and whether the day has been released. A timer releases a day that stays
    incomplete, another forgets it."""

    def __init__(self, need: int, hold_days: int, keep_days: int):
        self.need, self.hold, self.keep = need, timedelta(days=hold_days), timedelta(days=keep_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "file string", "there boolean")
        self.day = handle.getValueState("day", "n int, released boolean")

    def _rows(self, key, n: int, what: list[tuple[str, str | None]]) -> Iterator[pd.DataFrame]:
        if what:
            yield pd.DataFrame([(key[0], key[1], n, reason, file) for reason, file in what], columns=["satellite", "date", "n_files", "reason", "dataset_file"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, released = self.day.get() if self.day.exists() else (0, False)
        if n == 0 and not released:
            end = datetime.combine(key[1], datetime.min.time()) + timedelta(days=1)
            for wait in (self.hold, self.keep):
                self.handle.registerTimer(int((end + wait - datetime(1970, 1, 1)).total_seconds() * 1000))
        out: list[tuple[str, str | None]] = []
        for batch in rows:
            for file in batch["dataset_file"].dropna().unique().tolist():
                if not self.seen.containsKey((file,)):
                    self.seen.updateValue((file,), (True,))
                    n += 1
                    if released:
                        out.append(("late", file))
        if not released and n >= self.need:
            released = True
            out.append(("complete", None))
        self.day.update((n, released))
        yield from self._rows(key, n, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, released = self.day.get() if self.day.exists() else (0, True)
        end = datetime.combine(key[1], datetime.min.time()) + timedelta(days=1)
        if expiredTimerInfo.getExpiryTimeInMs() >= int((end + self.keep - datetime(1970, 1, 1)).total_seconds() * 1000):
            self.seen.clear()
            self.day.clear()
        elif not released:
            self.day.update((n, True))
            yield from self._rows(key, n, [("timer", None)])

    def close(self) -> None:
        pass


def released_days(files: DataFrame, expected: int = FILES_A_DAY, share: float = SHARE, hold_days: int = 3, keep_days: int = 60, delay: str = "1 hour") -> DataFrame:
    """A stream of satellite, date, n_files, reason, dataset_file: each day once, when enough of its files are there (`complete`) or the
    watermark is `hold_days` past its end (`timer`), and each file that comes for a day already released (`late`).

    files: a stream with satellite, dataset_file, time (null times are left out). A file counts once however often it comes. State is
    kept until the watermark is `keep_days` past the day's end. The session's state store must be RocksDB.
    """
    if keep_days <= hold_days:
        raise ValueError("a day is kept for longer than it is held")
    find_package(files.sparkSession)
    rows = files.where("time IS NOT NULL AND satellite IS NOT NULL").withWatermark("time", delay).select("satellite", F.to_date("time").alias("date"), "dataset_file", "time")
    return rows.groupBy("satellite", "date").transformWithStateInPandas(
        DayGate(least_files(expected, share), hold_days, keep_days), outputStructType="satellite string, date date, n_files int, reason string, dataset_file string", outputMode="Append", timeMode="EventTime"
    )


# --- the ledger --------------------------------------------------------------------------------------


def closed_days(ledger: DataFrame) -> DataFrame:
    """satellite, date, at of the days whose latest entry says `done`. ledger: satellite, date, action (done, reopened), at; of entries
    at one time `reopened` counts."""
    latest = ledger.groupBy("satellite", "date").agg(F.max(F.struct("at", (F.col("action") == "reopened").alias("open"))).alias("last"))
    return latest.where("NOT last.open").select("satellite", "date", F.col("last.at").alias("at"))


def judged_arrivals(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """files (satellite, date, arrived and others) and `late`: was the day closed when the file arrived? Entries and files of a day are
    put in one order of time; an entry at the very time of an arrival comes first."""
    names = files.columns
    entries = ledger.groupBy("satellite", "date", "at").agg(F.max((F.col("action") == "reopened").cast("int")).alias("open"))
    entries = entries.select("satellite", "date", F.col("at").alias("when"), F.lit(0).alias("kind"), (F.col("open") == 0).alias("closed"), F.lit(None).cast(files.select(F.struct(*names).alias("x")).schema["x"].dataType).alias("file"))
    rows = files.select("satellite", "date", F.col("arrived").alias("when"), F.lit(1).alias("kind"), F.lit(None).cast("boolean").alias("closed"), F.struct(*names).alias("file"))
    so_far = Window.partitionBy("satellite", "date").orderBy("when", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = entries.unionByName(rows).withColumn("late", F.coalesce(F.last("closed", ignorenulls=True).over(so_far), F.lit(False)))
    return both.where("kind = 1").select("file.*", "late")


class DayStore:
    """A store of detections by day. Each batch of groups is kept; a day is computed when it is complete, entered in the ledger, and
    from then on closed: rows that come later go to a side table until the day is opened again by an entry.

    Folders under `path`: groups, late and ledger by batch, and the detections by kind, satellite and date. A batch rewrites what it
    wrote before, so one that failed half-way can run again; its ledger entries come last and make it count.
    """

    def __init__(self, spark: SparkSession, path: str, detect: Callable[[DataFrame], DataFrame], kind: str = "detections", expected: int = FILES_A_DAY, share: float = SHARE, hold_days: int = 3):
        self.spark, self.path, self.detect, self.kind = spark, path.rstrip("/"), detect, kind
        self.expected, self.share, self.hold_days = expected, share, hold_days

    LEDGER = "satellite string, date date, action string, at timestamp, n_files long, batch string"

    def _there(self, folder: str) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def _put(self, rows: DataFrame, folder: str, batch: str) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.path}/{folder}")

    def _drop(self, folder: str, batch: str) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/batch={batch}")
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _get(self, folder: str, like: DataFrame) -> DataFrame:
        empty = like.where("false")
        if not self._there(folder):
            return empty
        return self.spark.read.schema(empty.schema).parquet(f"{self.path}/{folder}")

    def ledger(self) -> DataFrame:
        """The processing history: satellite, date, action, at, n_files, batch."""
        return self._get("ledger", self.spark.createDataFrame([], self.LEDGER))

    def reopen(self, satellite: str, day: date) -> None:
        """The next run computes the day anew, with the rows that came too late for it."""
        rows = self.spark.createDataFrame([(satellite, day, "reopened", datetime.now(), None)], "satellite string, date date, action string, at timestamp, n_files long")
        self._put(rows, "ledger", f"reopened-{uuid.uuid4().hex}")

    def late(self, like: DataFrame) -> DataFrame:
        """Rows that came after their day was closed, with the time of their arrival. like: rows of the store's groups."""
        return self._get("late", like.withColumn("date", F.to_date("time")).withColumns({"arrived": F.current_timestamp(), "batch": F.lit("")}))

    def run(self, rows: DataFrame, batch: str, today: date) -> list[tuple[str, date]]:
        """Takes in the rows of one batch (satellite, dataset_file, group_id, time and others), computes the days that are ready on
        `today` and returns them. Rows without a time or satellite have no day and are left out."""
        names = rows.columns
        rows = rows.where("time IS NOT NULL AND satellite IS NOT NULL").withColumn("date", F.to_date("time"))
        before = written(self.ledger().where(F.col("batch") != batch), "ledger")
        closed = closed_days(before)
        # both are rewritten whole: what a failed run of this batch left goes
        for folder, part in (("late", rows.join(closed, ["satellite", "date"], "left_semi").withColumn("arrived", F.current_timestamp())), ("groups", rows.join(closed, ["satellite", "date"], "left_anti"))):
            self._drop(folder, batch)
            self._put(part, folder, batch)
        kept = self._get("groups", rows.withColumn("batch", F.lit("")))
        late = self.late(rows)
        # of open days all late rows count, of closed ones those that were there when the day was done again
        state = closed.select("satellite", "date", F.col("at").alias("done_at"))
        late = late.join(state, ["satellite", "date"], "left").where(F.col("done_at").isNull() | (F.col("arrived") < F.col("done_at")))
        known = kept.unionByName(late.select(*kept.columns)).dropDuplicates(["dataset_file", "group_id"])
        files = known.groupBy("satellite", "dataset_file").agg(F.min("time").alias("start"))
        states = day_states(files, closed, F.lit(today), self.expected, self.share, self.hold_days)
        ready = [(r.satellite, r.date, r.n_files) for r in states.where("state = 'ready'").collect()]  # satellites times open days
        if ready:
            days = {d for _, d, _ in ready}
            near = sorted({d + timedelta(days=k) for d in days for k in (-2, -1, 0, 1, 2)})
            found = self.detect(known.where(F.col("date").isin(near)).select(*names))
            # a cluster over midnight changes the closed day beside it as well
            beside = {(r.satellite, r.date) for r in closed.where(F.col("date").isin(sorted({d + timedelta(days=k) for d in days for k in (-1, 1)}))).collect()}
            chosen = {(s, d) for s, d, _ in ready} | {(s, d) for s, d in beside if any((s, d + timedelta(days=k)) in {(x, y) for x, y, _ in ready} for k in (-1, 1))}
            pairs = self.spark.createDataFrame(sorted(chosen), "satellite string, date date")
            found = found.withColumn("date", F.to_date("time")).join(F.broadcast(pairs), ["satellite", "date"], "left_semi").drop("date")
            self.spark.createDataFrame([(found.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/schema")
            replace_days(written(found, self.kind), f"{self.path}/store", self.kind, chosen)
            entries = self.spark.createDataFrame([(s, d, "done", datetime.now(), n) for s, d, n in ready], "satellite string, date date, action string, at timestamp, n_files long")
        else:
            entries = self.spark.createDataFrame([], "satellite string, date date, action string, at timestamp, n_files long")
        self._drop("ledger", batch)
        if ready:
            self._put(entries, "ledger", batch)
        return sorted((s, d) for s, d, _ in ready)

    def detections(self) -> DataFrame:
        """The store as it is; a store without any rows has its columns all the same."""
        if not self._there("schema"):
            raise ValueError("no day has been computed yet")
        fields = T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/schema").first()[0]))
        fields = T.StructType([*fields.fields, T.StructField("kind", T.StringType()), T.StructField("date", T.DateType())])
        rows = self.spark.read.schema(fields).parquet(f"{self.path}/store") if self._there("store") else self.spark.createDataFrame([], fields)
        return rows.where(F.col("kind") == self.kind)

    def stream(self, groups: DataFrame, checkpoint: str, today: Callable[[], date]):
        """Runs every batch of a stream; stops when all files that are there are done."""

        def batch(rows: DataFrame, n: int) -> None:
            self.run(rows, f"stream-{n}", today())

        return groups.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
