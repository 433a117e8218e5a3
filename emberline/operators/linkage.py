"""Clusters: exact single linkage in time and distance, boundary rules, duplicates and identities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberline.functions.geo import EARTH_KM, haversine
from emberline.functions.times import stamp
from emberline.operators.components import components
from emberline.operators.scan import scanned, time_cell
from emberline.sources.scratch import written

KM_A_DEGREE = 111.19


def seconds(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")) / 1e6


class _Reach:
    """Cells of time, latitude and longitude as wide as the reach of a pair with (km / closeness_km)^2 + (s / closeness_s)^2 <= 2
    (degrees of longitude by the widest of three bands of latitude): rows that meet lie in the same cell or in one beside it."""

    def __init__(self, closeness_km: float, closeness_s: float):
        self.km, self.s = closeness_km, closeness_s
        self.wide_s, self.deg = math.sqrt(2) * closeness_s, math.sqrt(2) * closeness_km / KM_A_DEGREE
        edge = F.least(F.lit(90.0), (F.abs(F.col("lb") + 0.5) + 1.5) * self.deg)  # the latitude of the band nearest a pole
        width = 2 * F.degrees(F.asin(F.least(F.lit(1.0), math.sin(math.radians(self.deg) / 2) / F.greatest(F.lit(1e-9), F.cos(F.radians(edge))))))
        self.around = F.greatest(F.lit(1), F.floor(360 / width)).cast("long")  # cells of longitude in the band `lb`

    def column(self, lon: str) -> Column:
        """The cell of a longitude in the band `lb`."""
        return F.least(F.floor(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) * self.around / 360), self.around - 1)

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows (satellite, lat, lon, time, ...) with t and their cell tb, lb, xb."""
        rows = rows.withColumn("t", seconds(F.col("time"))).withColumns({"tb": F.floor(F.col("t") / self.wide_s), "lb": F.floor(F.col("lat") / self.deg)})
        return rows.withColumn("xb", self.column("lon"))

    def beside(self, rows: DataFrame, west: str, east: str) -> DataFrame:
        """rows once for each cell of their time and the next in which they are met; `later` is 1 in the next. west and east: the ends of
        their longitudes, both in one cell of their own band."""
        rows = rows.withColumn("lb", F.explode(F.array(*[F.col("lb") + k for k in (-1, 0, 1)])))
        first, last = self.column(west) - 1, self.column(east) + 1
        rows = rows.withColumn("xb", F.explode(F.array_distinct(F.transform(F.sequence(first, F.greatest(first, last)), lambda x: F.pmod(x, self.around)))))
        rows = rows.withColumn("later", F.explode(F.array(F.lit(0), F.lit(1)).cast("array<bigint>")))
        return rows.withColumn("tb", F.col("tb") + F.col("later"))

    def share(self, km: Column, s: Column) -> Column:
        return F.pow(km / self.km, 2) + F.pow(s / self.s, 2)


def close_pairs(groups: DataFrame, closeness_km: float, closeness_s: float, key: str = "group_id") -> DataFrame:
    """Pairs (u < v) of one satellite with (km / closeness_km)^2 + (s / closeness_s)^2 <= 2."""
    reach = _Reach(closeness_km, closeness_s)
    one = reach.placed(groups.select(F.col(key).alias("u"), "satellite", "lat", "lon", "time")).drop("time")
    other = reach.beside(one.withColumnsRenamed({"u": "v", "lat": "lat2", "lon": "lon2", "t": "t2"}), "lon2", "lon2")
    d = reach.share(haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), F.col("t") - F.col("t2"))
    # what a row is dealt to is not in the estimate of its table's size: no broadcast
    pairs = one.join(other.hint("merge"), ["satellite", "tb", "lb", "xb"]).where(d <= 2).where((F.col("later") == 1) | (F.col("u") < F.col("v")))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _span(low: str, high: str) -> tuple[Column, Column]:
    """The least and the greatest distance of two intervals' points: low .. high and low2 .. high2."""
    ahead, behind = F.col(low + "2") - F.col(high), F.col(low) - F.col(high + "2")
    return F.greatest(ahead, behind, F.lit(0.0)), F.greatest(F.col(high + "2") - F.col(low), F.col(high) - F.col(low + "2"))


def _bounds(reach: _Reach) -> tuple[Column, Column]:
    """The least and the greatest share of the reach that rows of two boxes can have: of haversines with the least and greatest
    differences of latitude and longitude and cosines of latitude, which a haversine grows with."""
    (t_least, t_most), (y_least, y_most) = _span("t_lo", "t_hi"), _span("y_lo", "y_hi")
    # longitudes in 0 .. 360: a difference and its way around differ from those of the middles by half the widths at most
    apart = F.abs((F.col("x_lo") + F.col("x_hi") - F.col("x_lo2") - F.col("x_hi2")) / 2)
    apart = F.least(apart, 360.0 - apart)
    half = (F.col("x_hi") - F.col("x_lo") + F.col("x_hi2") - F.col("x_lo2")) / 2
    x_least, x_most = F.greatest(apart - half, F.lit(0.0)), F.least(apart + half, F.lit(180.0))
    cos_least = [F.cos(F.radians(F.greatest(F.abs("y_lo" + k), F.abs("y_hi" + k)))) for k in ("", "2")]
    cos_most = [F.cos(F.radians(F.greatest(F.col("y_lo" + k), -F.col("y_hi" + k), F.lit(0.0)))) for k in ("", "2")]

    def km(y: Column, x: Column, cos: list[Column]) -> Column:
        h = F.pow(F.sin(F.radians(y) / 2), 2) + cos[0] * cos[1] * F.pow(F.sin(F.radians(x) / 2), 2)
        return 2 * EARTH_KM * F.asin(F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), h))))

    return reach.share(km(y_least, x_least, cos_least), t_least), reach.share(km(y_most, x_most, cos_most), t_most)


def _node_edges(groups: DataFrame, closeness_km: float, closeness_s: float) -> DataFrame:
    """Distinct pairs (u < v) of nodes of which any two rows are within the reach. groups: group_id, node, satellite, lat, lon, time.

    A node's rows of one cell are a box with the ends of their times and places. Boxes meet by an equi-join of cells; most are within
    the reach with all their rows or beyond it, and only where the boxes cannot tell and no other boxes of the two nodes have, rows meet.
    """
    reach, cell = _Reach(closeness_km, closeness_s), ["satellite", "node", "tb", "lb", "xb"]
    rows = reach.placed(groups.select("node", "satellite", "lat", "lon", "time"))
    x = F.pmod(F.col("lon") + 180.0, F.lit(360.0))
    ends = [f(v).alias(name + end) for name, v in (("t", F.col("t")), ("y", F.col("lat")), ("x", x)) for f, end in ((F.min, "_lo"), (F.max, "_hi"))]
    boxes = written(rows.groupBy(*cell).agg(*ends), "boxes")
    sides = [f"{c}_{end}" for c in "tyx" for end in ("lo", "hi")]
    other = boxes.withColumns({"tc": F.col("tb"), "lc": F.col("lb"), "xc": F.col("xb"), "_w": F.col("x_lo") - 180, "_e": F.col("x_hi") - 180})
    other = reach.beside(other, "_w", "_e").drop("_w", "_e").withColumnsRenamed({c: c + "2" for c in ("node", *sides)})
    least, most = _bounds(reach)
    # what a box is dealt to is not in the estimate of its table's size: no broadcast
    met = boxes.join(other.hint("merge"), ["satellite", "tb", "lb", "xb"]).where("node <> node2")
    met = met.withColumns({"_least": least, "_most": most}).where(F.col("_least") <= 2 + 1e-6)  # rounding is far below
    own, pair = F.struct("tb", "lb", "xb", "node"), F.struct(F.col("tc").alias("tb"), F.col("lc").alias("lb"), F.col("xc").alias("xb"), F.col("node2").alias("node"))
    met = met.select("satellite", F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v"), (F.col("_most") <= 2 - 1e-6).alias("sure"), F.least(own, pair).alias("a"), F.greatest(own, pair).alias("b"))
    met = written(met.distinct(), "met")
    sure = met.where("sure").select("u", "v").distinct()
    unsure = met.where("not sure").join(sure, ["u", "v"], "left_anti").select("u", "v", "satellite", "a", "b")
    box = lambda side: [F.col(f"{side}.{c}").alias(c) for c in cell[1:]]
    one = unsure.select("u", "v", "satellite", "b", *box("a")).join(rows.hint("merge"), cell).select("u", "v", "satellite", "lat", "lon", "t", *box("b"))
    two = rows.select(*cell, F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("t").alias("t2"))
    d = reach.share(haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), F.col("t") - F.col("t2"))
    return sure.unionByName(one.join(two.hint("merge"), cell).where(d <= 2).select("u", "v")).distinct()


def _labelled(groups: DataFrame, edges: DataFrame, least: int, pairs_alone: bool) -> DataFrame:
    """groups (with their node) with cid and n of the components of edges between nodes."""
    labels = written(components(edges), "labels").withColumnRenamed("component", "cid")
    out = groups.join(labels, "node", "left").withColumn("cid", F.coalesce("cid", "node")).drop("node")
    out = written(out, "clusters")
    sizes = out.groupBy("cid").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    if not pairs_alone:
        sizes = sizes.where("n <> 2")
    return out.join(sizes, "cid").select(*out.columns, "n")


#: Time cells of a place that are chained in one window; chains of longer spans are joined by edges.
_CHAINED = 4096


def _with_node(groups: DataFrame, along: Column, place: list[Column]) -> DataFrame:
    """groups with node, the smallest group_id of a chain of rows that are in one cluster anyway: rows of one place
    whose `along` (time by closeness) differs by one at most from the next. Rows are counted by cells of `along`
    first, so a chain is found on cells, a bounded number of them in a window."""
    names = [f"_f{i}" for i in range(len(place))]
    rows = groups.withColumns({**dict(zip(names, place)), "_a": along, "_c": F.floor(along)})
    cells = rows.groupBy("satellite", *names, "_c").agg(F.min("group_id").alias("_least"), F.min("_a").alias("_from"), F.max("_a").alias("_to"))
    span = Window.partitionBy("satellite", *names, F.floor(F.col("_c") / _CHAINED))
    gap = F.col("_from") - F.lag("_to").over(span.orderBy("_c"))
    cells = cells.withColumn("_new", F.coalesce((gap > 0.999999).cast("int"), F.lit(1)))
    cells = cells.withColumn("_run", F.sum("_new").over(span.orderBy("_c")))
    run = Window.partitionBy("satellite", *names, F.floor(F.col("_c") / _CHAINED), "_run")
    nodes = cells.select("satellite", *names, "_c", F.min("_least").over(run).alias("node"))
    return written(rows.join(nodes, ["satellite", *names, "_c"]).drop(*names, "_c", "_a"), "groups")


def single_linkage(groups: DataFrame, closeness_km: float = 14.0, closeness_s: float = 0.2, least: int = 1, pairs_alone: bool = True) -> DataFrame:
    """groups with cid (the smallest group_id of the cluster) and n, of clusters of `least` groups or more.
    Without pairs_alone clusters of exactly two are dropped, as the strict mode of small blocks asks.

    Rows that follow each other closely in one small place are in one cluster anyway: the graph has such chains
    as nodes, and its edges do not grow with the square of the rows of a dense place.
    """
    deg = 0.999 * closeness_km / math.sqrt(2) / KM_A_DEGREE
    groups = _with_node(groups, seconds(F.col("time")) / closeness_s, [F.floor(F.col("lat") / deg), F.floor(F.col("lon") / deg)])
    edges = _node_edges(groups, closeness_km, closeness_s)
    return _labelled(groups, edges, least, pairs_alone)


def radial_linkage(groups: DataFrame, closeness_km: float = 14.0, closeness_s: float = 0.2, least: int = 1) -> DataFrame:
    """As single_linkage, in the plane of time and distance from the satellite's first group: rows at one distance
    count as close in whatever direction they lie."""
    first = groups.groupBy("satellite").agg(F.min_by(F.struct("lat", "lon"), F.struct("time", "group_id")).alias("_o"))
    y = haversine(F.col("_o.lat"), F.col("_o.lon"), F.col("lat"), F.col("lon")) / closeness_km
    rows = groups.join(first, "satellite").withColumns({"_x": seconds(F.col("time")) / closeness_s, "_y": y}).drop("_o")
    rows = _with_node(rows, F.col("_x"), [F.floor("_y")])
    reach = math.sqrt(2)
    one = rows.select("satellite", "node", "_x", "_y", F.floor(F.col("_x") / reach).alias("bx"), F.floor(F.col("_y") / reach).alias("by"))
    other = one.select("satellite", F.col("node").alias("node2"), F.col("_x").alias("x2"), F.col("_y").alias("y2"), F.explode(F.array("bx", F.col("bx") + 1)).alias("bx"), "by")
    other = other.withColumn("by", F.explode(F.array(F.col("by") - 1, F.col("by"), F.col("by") + 1)))
    near = (F.col("node") != F.col("node2")) & (F.pow(F.col("_x") - F.col("x2"), 2) + F.pow(F.col("_y") - F.col("y2"), 2) <= 2)
    edges = one.join(other.hint("merge"), ["satellite", "bx", "by"]).where(near).select(F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v")).distinct()
    return _labelled(rows.drop("_x", "_y"), edges, least, True)


def by_time(rows: DataFrame) -> DataFrame:
    """One row a cluster with its members as an array in (time, id) order."""
    fields = [c for c in ("time", "group_id", "dataset_file", "lat", "lon", "energy") if c in rows.columns]
    return rows.groupBy("cid").agg(F.first("satellite").alias("satellite"), F.array_sort(F.collect_list(F.struct(*fields))).alias("members"))


def boundary_filter(clusters: DataFrame, files: DataFrame) -> DataFrame:
    """Clusters whose middle member lies in the time range of its file's day and whose times are not all
    the same (files: dataset_file, start, end)."""
    n = F.size("members")
    middle = F.element_at("members", (F.floor(n / 2) + 1).cast("int"))
    times = F.transform("members", lambda m: m["time"])
    rows = clusters.withColumns({"_t": middle["time"], "_f": F.element_at("members", 1)["dataset_file"], "_same": (n > 1) & (F.array_min(times) == F.array_max(times))})
    f = files.select(F.col("dataset_file").alias("_f"), "start", "end")
    return rows.join(f, "_f").where("_t between start and end and not _same").drop("_t", "_f", "_same", "start", "end")


def without_duplicates(detections: DataFrame) -> DataFrame:
    """One row for each set of member ids: the one of the primary file first (is_primary), then by `ord`. Sets are
    told apart by a SHA-256 digest of their ids in order, so no row is dealt or sorted by its whole list."""
    ids = F.col("members.group_id")
    key = F.sha2(F.concat_ws(",", F.size(ids).cast("string"), F.sort_array(ids).cast("array<string>")), 256)  # the size counts ids that are null
    w = Window.partitionBy("_ids").orderBy(F.col("is_primary").desc(), "ord")
    return detections.withColumn("_ids", key).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_ids", "_rn")


def detection_ids(detections: DataFrame, existing: DataFrame | None = None, time: str = "time") -> DataFrame:
    """detection_id: satellite, stamp and a counter of three digits from 1, counting on from `existing`
    ids of the same prefix. A counter of 1000 is an error, raised when it is read."""
    prefix = F.concat(F.regexp_extract("satellite", r"(\d+)", 1), stamp(F.col(time))).cast("long")
    rows = detections.withColumn("_prefix", prefix)
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_prefix").orderBy(time, "cid")))
    if existing is not None:
        used = existing.groupBy(F.floor(F.col("detection_id") / 1000).alias("_prefix")).agg(F.max(F.col("detection_id") % 1000).alias("_used"))
        rows = rows.join(used, "_prefix", "left").withColumn("_n", F.col("_n") + F.coalesce("_used", F.lit(0))).drop("_used")
    ok = F.assert_true(F.col("_n") < 1000, F.lit("more than 999 detections of one stamp"))
    return rows.withColumn("detection_id", F.col("_prefix") * 1000 + F.col("_n") + F.when(ok.isNull(), 0)).drop("_prefix", "_n")


def condensed(rows: DataFrame, key: str, gap_seconds: float, cell_s: float = 3600.0) -> DataFrame:
    """Rows of one key closer than the gap to the one before become one: the first time, the summed energy. Runs are
    numbered from 1 in the order of time; the order is scanned by cells of time."""
    cell, order = time_cell("time", cell_s), ["time", "group_id"]
    rows = scanned(rows, [key], order, cell, before={"_last": F.col("time")})
    new = F.coalesce((seconds(F.col("time")) - seconds(F.col("_last")) >= gap_seconds).cast("int"), F.lit(1))
    rows = scanned(rows, [key], order, cell, sums={"run": new})
    return rows.groupBy(key, "run").agg(F.min("time").alias("time"), F.sum("energy").alias("energy"), F.count("*").alias("n")).withColumn("run", F.col("run").cast("long"))


def merge_by_box(rows: DataFrame, boxes: DataFrame) -> DataFrame:
    """Explicit clusters: the rows in each box are one cluster, tagged with the box."""
    b = F.broadcast(boxes)  # a list of boxes written by hand
    inside = (rows["lat"] >= b["lat_lo"]) & (rows["lat"] <= b["lat_hi"]) & (rows["lon"] >= b["lon_lo"]) & (rows["lon"] <= b["lon_hi"])
    return rows.join(b, inside)
