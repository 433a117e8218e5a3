"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates and queries are dealt into blocks; every candidate block meets every query block in one
task. In a block each dimension has a list of its candidates sorted by value. A query walks all lists
at once (from the top where its own component is positive, from the bottom where negative), scores
each candidate it meets in full, and stops when the threshold - the score that a candidate not yet
met could have at most - is below its k-th best score. Ties go on until none can be missed, as the
smaller id wins. The best k of the blocks are merged by a window over at most k rows a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberline.session import find_package

from .common import written

#: The least and the largest 64-bit integer.
LONGS = (-(2**63), 2**63 - 1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids, in this order."""
    if len(scores) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


class SortedLists:
    """A block of vectors with a list per dimension, sorted by value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        self.ids, self.vectors, self.rows = ids, vectors, ids if rows is None else rows
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def top(self, query: np.ndarray, own: int, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray, int]:
        """ids and scores of the k best but the row `own`, and how deep the lists were read."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        if not len(dims):  # every score is 0: the smallest ids
            dims = np.arange(min(1, self.vectors.shape[1]))
        up = query[dims] > 0
        seen = np.zeros(n, bool)
        met = np.zeros(0, np.int64)
        scores = np.zeros(0, np.int64)
        depth = 0
        while depth < n:
            to = min(n, max(step, 2 * depth))
            low = self.order[depth:to][:, dims[~up]]
            high = self.order[n - to : n - depth][:, dims[up]]
            fresh = np.zeros(n, bool)
            fresh[low.ravel()] = True
            fresh[high.ravel()] = True
            if not query.any():
                fresh[:] = True
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            new = new[self.rows[new] != own]
            met = np.concatenate([met, new])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            depth = to
            edge = np.where(up, self.values[n - to, dims], self.values[to - 1, dims])
            keep = best(scores, self.ids[met], k)
            met, scores = met[keep], scores[keep]
            if len(met) == k and scores[-1] > int(edge @ query[dims]):
                break
        return self.ids[met], scores, depth


def top_k(vectors: DataFrame, id_column: str, vector_column: str, query_rows: Column, k: int = 10, scale: int = 1024, block: int = 4096, query_block: int = 512) -> DataFrame:
    """The k highest inner products of every query row with all other rows: query_id, rank, vec_id, score.

    Components become floor(scale * x) as integers. Rows with a null id, a null or empty vector, or
    null or non-finite components take no part; ties go to the smaller id; rows that repeat an id are
    rows of their own: a query row leaves out itself only, and each has its k ranks. A query of which
    there are fewer than k others gets all of them. Vectors of unequal length are compared over the
    longer one's length, missing components being 0. Scaled components and scores that do not fit 64
    bits stand at the nearest 64-bit integer. Other columns are not read. An empty table gives an empty result.
    """
    row = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"), query_rows.alias("is_query"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    row = row.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)
    row = row.select("vec_id", "is_query", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    row = written(row.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = row.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    n_blocks, n_query_blocks = max(1, -(-sizes["n"] // block)), max(1, -(-(sizes["q"] or 0) // query_block))
    spread = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = row.select("vec_id", "row", "v", spread(n_blocks, 1).alias("cb")).withColumn("qb", every(n_query_blocks))
    queries = row.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), F.col("v").alias("query"), spread(n_query_blocks, 2).alias("to_qb")).withColumn("to_cb", every(n_blocks))

    def meet(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            width = max(candidates["v"].map(len).max(), queries["query"].map(len).max())
            large = max(float(np.abs(np.asarray(x, float)).max()) for side in (candidates["v"], queries["query"]) for x in side)
            kind = np.int64 if width * large * large < 2.0**62 else object  # Python's integers where products are large
            full = lambda s: np.array([np.pad(np.asarray(x, np.int64), (0, width - len(x))) for x in s]).astype(kind)
            lists = SortedLists(candidates["vec_id"].to_numpy(np.int64), full(candidates["v"]), candidates["row"].to_numpy(np.int64))
            for name, own, query in zip(queries["query_id"], queries["own"], full(queries["query"]), strict=True):
                ids, scores, depth = lists.top(query, own, k)
                out.append(pd.DataFrame({"query_id": name, "own": own, "vec_id": ids, "score": scores.clip(*LONGS).astype(np.int64), "depth": depth}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "own", "vec_id", "score", "depth")})

    find_package(vectors.sparkSession)
    found = candidates.groupBy("cb", "qb").cogroup(queries.groupBy("to_cb", "to_qb")).applyInPandas(meet, "query_id long, own long, vec_id long, score long, depth long")
    rank = F.row_number().over(Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
