"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node, itself included) of every node of edges (u, v: bigint).

    Every round points nodes at the smallest node they know of, so a few rounds do; each round's edges
    are written before the next. A hub of many edges meets one row in a join that can be split.
    Nodes without edges do not occur; loops and repeated edges change nothing.
    """
    edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        # large star: every neighbour above u is joined to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        large = written(large, "edges")
        # small star: the neighbours below v, and v, are joined to the smallest of them
        least = written(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        small = large.join(least, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u <> v").distinct()
        edges = written(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.crc32(F.concat_ws(",", "u", "v")))).first()
        if now == state:
            break
        state = now
    # now each node but the smallest of its component has one edge, to that one
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
