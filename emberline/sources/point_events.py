"""Scans, neighbour files, stores and sinks of point events."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

GROUP_SCHEMA = T.StructType(
    [
        T.StructField("group_id", T.LongType()),
        T.StructField("satellite", T.StringType()),
        T.StructField("dataset_file", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("energy", T.LongType()),
        T.StructField("quality", T.IntegerType()),
    ]
)

#: Satellites by side, for `satellites()`.
SIDES = {"east": ["G16", "G19"], "west": ["G17", "G18"], "all": ["G16", "G17", "G18", "G19"]}


def satellites(option: str) -> list[str]:
    return SIDES.get(option, [option])


def groups_of_events(events: DataFrame) -> DataFrame:
    """The driver's event stream as point groups of four satellites on twelve sites."""
    sat = F.element_at(F.array(*[F.lit(s) for s in ("G16", "G17", "G18", "G19")]), (F.col("user_id") % 4 + 1).cast("int"))
    time = F.col("ts").cast("timestamp")
    west = ~(F.col("user_id") % 4).isin(0, 3)
    return events.select(
        F.col("event_id").cast("long").alias("group_id"),
        sat.alias("satellite"),
        F.concat(sat, F.lit("_"), F.to_date("ts").cast("string")).alias("dataset_file"),
        time.alias("time"),
        (((F.col("user_id") % 6 * 17) % 100 - 50).cast("double") + (F.col("event_id") * 7 % 21 - 10).cast("double") * F.lit(0.002)).alias("lat"),
        (F.when(west, F.lit(-137.0)).otherwise(F.lit(-75.0)) + (F.col("user_id") * 13 % 3 * 2).cast("double") + (F.col("event_id") * 11 % 21 - 10).cast("double") * F.lit(0.002)).alias("lon"),
        F.round(F.col("value") * 100).cast("long").alias("energy"),
        F.when(F.col("event_id") % 50 == 0, 1).when(F.col("event_id") % 97 == 0, 5).otherwise(0).alias("quality"),
        F.col("event_type").alias("event_type"),
    )


def load_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def scan_groups(groups: DataFrame, ids: DataFrame | None = None, drop_zero_energy: bool = True, drop_bad_quality: bool = True, files: DataFrame | None = None, pad_seconds: float = 10.0) -> DataFrame:
    """Groups by quality and energy, or by a list of ids (unknown ones are ignored); with `files`
    (dataset_file, start, end) only those within the padded coverage of their file."""
    if ids is not None:
        if drop_zero_energy or drop_bad_quality:
            raise ValueError("a scan by ids takes no quality or energy filter")
        return groups.join(ids, ["dataset_file", "group_id"], "left_semi")
    if drop_zero_energy:
        groups = groups.where("energy > 0")
    if drop_bad_quality:
        groups = groups.where("quality = 0")
    if files is not None:
        pad = F.make_dt_interval(secs=F.lit(pad_seconds))
        f = files.select("dataset_file", (F.col("start") - pad).alias("_from"), (F.col("end") + pad).alias("_to"))
        groups = groups.join(f, "dataset_file").where("time between _from and _to").drop("_from", "_to")
    return groups


def file_table(groups: DataFrame) -> DataFrame:
    return groups.groupBy("satellite", "dataset_file").agg(F.min("time").alias("start"), F.max("time").alias("end"), F.count("*").alias("n_groups"))


def with_neighbours(files: DataFrame, gap_seconds: float) -> DataFrame:
    """Each file and its neighbours of the same satellite: primary, dataset_file, is_primary. The previous
    file counts if the starts, the next if the ends, are less than gap_seconds apart; an empty primary
    file has no neighbours."""
    w = Window.partitionBy("satellite").orderBy("start", "dataset_file")
    s = lambda c: F.unix_micros(c) / 1e6
    f = files.withColumns({"_prev": F.lag("dataset_file").over(w), "_next": F.lead("dataset_file").over(w), "_back": s(F.col("start")) - s(F.lag("start").over(w)), "_ahead": s(F.lead("end").over(w)) - s(F.col("end"))})
    near = F.array(
        F.struct(F.col("dataset_file").alias("f"), F.lit(True).alias("p")),
        F.when((F.col("_back") < gap_seconds) & (F.col("n_groups") > 0), F.struct(F.col("_prev").alias("f"), F.lit(False).alias("p"))),
        F.when((F.col("_ahead") < gap_seconds) & (F.col("n_groups") > 0), F.struct(F.col("_next").alias("f"), F.lit(False).alias("p"))),
    )
    return f.select("satellite", F.col("dataset_file").alias("primary"), F.explode(near).alias("x")).where("x.f is not null").select("satellite", "primary", F.col("x.f").alias("dataset_file"), F.col("x.p").alias("is_primary"))


def primary_windows(groups: DataFrame, expanded: DataFrame, files: DataFrame, closeness_s: float, factor: float = 10.0) -> DataFrame:
    """Groups of each primary file and those of its neighbours within factor * closeness of its time range."""
    span = files.select(F.col("dataset_file").alias("primary"), "start", "end")
    pad = F.make_dt_interval(secs=F.lit(factor * closeness_s))
    rows = groups.join(expanded.drop("satellite"), "dataset_file").join(span, "primary")
    return rows.where(F.col("is_primary") | ((F.col("time") >= F.col("start") - pad) & (F.col("time") <= F.col("end") + pad))).drop("start", "end")


def events_around(events: DataFrame, t0: Column, seconds: float, exclude: DataFrame | None = None) -> DataFrame:
    """Events within `seconds` (an hour at most) of t0, both ends included, less an exclusion list."""
    if seconds > 3600:
        raise ValueError("an hour at most")
    half = F.make_dt_interval(secs=F.lit(float(seconds)))
    out = events.where((F.col("time") >= t0 - half) & (F.col("time") <= t0 + half))
    return out if exclude is None else out.join(exclude, ["dataset_file", "group_id"], "left_anti")


def children(groups: DataFrame, events: DataFrame) -> DataFrame:
    """Number and energy of each group's child events."""
    kids = events.groupBy("dataset_file", "parent_group_id").agg(F.count("*").alias("n_children"), F.sum("energy").alias("child_energy"))
    return groups.select("dataset_file", "group_id").join(kids.withColumnRenamed("parent_group_id", "group_id"), ["dataset_file", "group_id"])


def pixel_table(spark: SparkSession, path: str) -> DataFrame:
    """A pixel navigation table from CSV; rows with a missing number are dropped."""
    return spark.read.csv(path, header=True, schema="x int, y int, lat double, lon double").dropna()


def layout_of(path: Column) -> tuple[Column, Column]:
    """How a file's folder is laid out (hours: Y/DOY/HH, days: Y/MMDD, bundles: daily archives) and its day; null for others."""
    hours, days, bundles = r"/(20\d{2}/\d{3})/\d{2}/[^/]*$", r"/(20\d{2}/\d{4})/[^/]*$", r"_s(20\d{6})\.nc\.tgz$"
    kind = F.when(path.rlike(bundles), "bundles").when(path.rlike(hours), "hours").when(path.rlike(days), "days")
    day = F.when(kind == "bundles", F.to_date(F.regexp_extract(path, bundles, 1), "yyyyMMdd")).when(kind == "days", F.to_date(F.regexp_extract(path, days, 1), "yyyy/MMdd"))
    found = F.regexp_extract(path, hours, 1)
    of_year = F.date_add(F.make_date(F.substring(found, 1, 4).cast("int"), F.lit(1), F.lit(1)), F.substring(found, 6, 3).cast("int") - 1)
    return kind, day.otherwise(F.when(kind == "hours", of_year))


def area_averaged(pixels: DataFrame, k: int) -> DataFrame:
    """Bands (x, y, band, value) on a grid k times coarser, the mean of a block's pixels each."""
    return pixels.groupBy(F.floor(F.col("x") / k).alias("x"), F.floor(F.col("y") / k).alias("y"), "band").agg(F.avg("value").alias("value"))


def truth_csv(truth: DataFrame, path: str) -> None:
    """One line a truth event, positions and energies averaged over its satellites: id, start, end, lat, lon, energy."""
    rows = truth.groupBy("idx").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.avg("energy").alias("energy"), F.concat_ws(" ", F.array_sort(F.collect_set("satellite"))).alias("satellites"))
    rows.write.mode("overwrite").option("header", "true").csv(path)


def label_csvs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Label files put together by the names in their headers, whatever the order of their columns; a column that a
    file lacks is null there."""
    out = None
    for p in paths:
        one = spark.read.csv(p, header=True, inferSchema=False)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def append_store(rows: DataFrame, path: str, kind: str) -> None:
    """Adds detections or rejections to a store partitioned by kind, satellite and date."""
    rows.withColumns({"kind": F.lit(kind), "date": F.to_date("time")}).write.mode("append").partitionBy("kind", "satellite", "date").parquet(path)


def replace_days(rows: DataFrame, path: str, kind: str, days: Iterable[tuple[str | None, date]] = ()) -> None:
    """Replaces whole days of a store, atomically by partition: a run that is repeated adds nothing twice. Of `days`
    (satellite, or null for all, and date) those without any rows lose their partition, once the others are written."""
    rows = rows.withColumns({"kind": F.lit(kind), "date": F.to_date("time")})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "satellite", "date").parquet(path)
    days = set(days)
    if not days:
        return
    spark = rows.sparkSession
    filled = {(r.satellite, r.date) for r in rows.select("satellite", "date").distinct().collect()}  # of the days asked for
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/kind={kind}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return
    for satellite in files.listStatus(folder):
        name = satellite.getPath().getName().removeprefix("satellite=")
        for day in {d for s, d in days if s in (None, name)} - {d for s, d in filled if s == name}:
            files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(satellite.getPath(), f"date={day.isoformat()}"), True)


def extract_store(spark: SparkSession, path: str, kind: str, ids: DataFrame | None = None) -> DataFrame:
    """A kind's rows, of the given ids only (unknown ones are ignored)."""
    rows = spark.read.option("mergeSchema", "true").parquet(path).where(F.col("kind") == kind)
    return rows if ids is None else rows.join(ids, "detection_id", "left_semi")


def detections_csv(detections: DataFrame, path: str) -> None:
    """One line a detection: id, scores, member list as id:file pairs, median position."""
    members = F.concat_ws(" ", F.transform("members", lambda m: F.concat_ws(":", m["group_id"].cast("string"), m["dataset_file"])))
    detections.select("detection_id", "satellite", "time", "triage_score", "lat", "lon", members.alias("members")).write.mode("overwrite").option("header", "true").csv(path)
