"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.sources.scratch import written


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either the smaller end of all its edges or the greater end of its only one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.max("up").alias("up"), F.sum("down").alias("down")).where("down + up > 1 and down > 0").isEmpty()


#: Edges up to which one task labels the graph (16 bytes each); beyond it rounds over all tasks do.
ONE_TASK = 500_000


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels of a graph that fits a task: every node takes the smallest label beside it, then that label's own, until nothing changes."""
    rows = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if not rows:
        return
    node, ends = np.unique(np.concatenate([x for pair in zip(*rows, strict=True) for x in pair]), return_inverse=True)
    u, v = ends.reshape(2, -1)
    label = np.arange(len(node))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        for at in (u, v, label[u], label[v]):
            np.minimum.at(new, at, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label])], names=["node", "component"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """node and component (its smallest reachable node, itself included) of every node of edges (u, v: bigint).

    Every round points nodes at the smallest node they know of, so a few rounds do; each round's edges
    are written before the next. A hub of many edges meets one row in a join that can be split.
    Nodes without edges do not occur; loops and repeated edges change nothing. A graph of one_task edges or fewer is
    labelled in one task instead, with the same result.
    """
    edges = written(edges.where("u <> v").select(F.least("u", "v").cast("long").alias("u"), F.greatest("u", "v").cast("long").alias("v")).distinct(), "edges")
    if edges.count() <= one_task:
        return edges.coalesce(1).mapInArrow(_labelled, "node long, component long")
    while not _all_stars(edges):
        # large star: every neighbour above u is joined to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        large = written(large, "edges")
        # small star: the neighbours below v, and v, are joined to the smallest of them
        least = written(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        small = large.join(least, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).where("u <> v").distinct()
        edges = written(small, "edges")
    # now each node but the smallest of its component has one edge, to that one
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
