"""Document quality by Bradley-Terry ranking.

A preference pair is a document labelled 1 and one labelled 0: the model says that the first wins with
probability sigmoid(s(first) - s(second)), where s is linear in text features, and its weights are
fitted by the logistic loss on feature differences. Every labelled document outside the held-out fold
takes part: features of all are stored, dealt to blocks by a hash of the id, and each Newton round sums
the gradient and the curvature of all blocks in Spark. Within a block every document of the smaller
class meets others in turn until all of the larger one are met, so pairs are balanced over both
classes. The cut of the scores is a quantile: the share of 0 labels in the training folds, read off
all training scores by counts of ever narrower ranges and placed at `cut` of the output scale.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.sources.scratch import written

from .common import arrow_map, chunks
from .textstats import N_FEATURES, document_stats

#: Labelled documents of a block on average; a block's pairs are drawn in its task.
BLOCK = 4096
#: Pairs of a document of the larger class of a block.
MEETINGS = 4


def expand(x: np.ndarray) -> np.ndarray:
    """Features, their squares and the products that tell sparse signals apart."""
    return np.concatenate([x, x * x, np.sqrt(np.abs(x))], axis=1)


class RankModel:
    """Scores from text features: sigmoid((s - threshold) / width + logit(cut))."""

    def __init__(self, weights: np.ndarray, scale: np.ndarray, threshold: float, width: float, cut: float):
        self.weights, self.scale, self.threshold, self.width, self.cut = weights, scale, threshold, width, cut

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = expand(x) / self.scale @ self.weights
        z = (raw - self.threshold) / self.width + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Expanded features and labels of stored rows."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, N_FEATURES)
    return expand(x), batch.column("y").to_numpy(zero_copy_only=False)


def _summed(rows: DataFrame, of) -> np.ndarray | None:
    """The sum over all batches of of(batch), an array of fixed size (None: nothing); one array a task comes to the driver's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            v = of(batch) if batch.num_rows else None
            if v is not None:
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    out = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.array_sort(F.collect_list("v")).alias("v")).collect()  # in one order: the same sum each time
    return None if not out else np.array([sum(r["v"]) for r in sorted(out, key=lambda r: r["i"])])


def _differences(block: pd.DataFrame, scale: np.ndarray) -> np.ndarray:
    """Features of better less worse for the pairs of a block: the smaller class in turns against MEETINGS rotations of the larger."""
    block = block.sort_values("doc_id")
    x, y = expand(np.stack(block["x"].to_numpy()).astype(np.float64)) / scale, block["y"].to_numpy()
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return np.zeros((0, x.shape[1]))
    n = max(len(good), len(bad))
    at = np.arange(n)
    return np.concatenate([good[at % len(good)] - bad[(at + k * (1 + n // MEETINGS)) % len(bad)] if len(good) == n else good[(at + k * (1 + n // MEETINGS)) % len(good)] - bad[at] for k in range(MEETINGS)])


def fit_pairs(rows: DataFrame, scale: np.ndarray, rounds: int = 12, ridge: float = 1e-4) -> np.ndarray:
    """Weights w of x / scale so that mean log(1 + exp(-w.(better - worse))) + ridge / 2 |w|^2 over the pairs of all blocks is least: Newton's
    method with halved steps. rows: block, doc_id, x, y."""
    d = len(scale)
    w = np.zeros(d)

    def told(ws: list[np.ndarray]) -> tuple[int, list[float], list[np.ndarray], np.ndarray]:
        def of(block: pd.DataFrame) -> pd.DataFrame:
            diff = _differences(block, scale)
            z = [diff @ v for v in ws]
            p = [1 / (1 + np.exp(np.clip(u, -500, 500))) for u in z]
            heads = [float(len(diff)), *[float(np.logaddexp(0, -u).sum()) for u in z]]
            curves = [np.concatenate([-(q @ diff), ((diff * (q * (1 - q))[:, None]).T @ diff).ravel()]) for q in p]
            return pd.DataFrame({"block": [int(block["block"].iloc[0])], "v": [np.concatenate([heads, *curves])]})

        sums = rows.groupBy("block").applyInPandas(of, "block long, v array<double>").select("block", F.posexplode("v").alias("i", "v"))
        sums = sums.groupBy("i").agg(F.aggregate(F.array_sort(F.collect_list("v")), F.lit(0.0), lambda a, v: a + v).alias("v")).orderBy("i").toPandas()["v"].to_numpy()
        n, at = max(1.0, sums[0]), 1 + len(ws)
        own = [sums[at + k * (d + d * d) : at + (k + 1) * (d + d * d)] / n for k in range(len(ws))]
        return sums[0], [sums[1 + k] / n + ridge / 2 * v @ v for k, v in enumerate(ws)], [g[:d] + ridge * v for g, v in zip(own, ws, strict=True)], [g[d:].reshape(d, d) + ridge * np.eye(d) for g in own]

    n, (loss,), (g,), (h,) = told([w])
    for _ in range(rounds if n else 0):
        step = np.linalg.solve(h, g)
        tried = [w - step * s for s in (1.0, 0.25)]
        _, losses, gs, hs = told(tried)
        k = int(np.argmin(losses))
        if losses[k] > loss - 1e-7:
            break
        w, loss, g, h = tried[k], losses[k], gs[k], hs[k]
    return w


def _ranked(scores: DataFrame, place: int) -> float:
    """The value s at a place (from 0) in the ascending order of all rows, by counts of a thousand ranges of ever smaller width."""
    low, high, before = *scores.agg(F.min("s"), F.max("s")).first(), 0
    while high > low:
        inside = scores.where(F.col("s").between(low, high))
        width = (high - low) / 1000
        if not width or low + width == low:
            break
        counts = inside.groupBy(F.least(F.floor((F.col("s") - low) / width), F.lit(999)).alias("k")).agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).orderBy("k").collect()
        for r in counts:
            if before + r["n"] > place:
                low, high = r["a"], r["b"]
                break
            before += r["n"]
    return low


def fit(rows: DataFrame, cut: float) -> RankModel:
    """A model of all rows (block, doc_id, x, y); the share of label 0 is the quantile of the cut."""
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    good, bad, d = sizes.get(1, 0), sizes.get(0, 0), 3 * N_FEATURES
    if not good or not bad:  # nothing to compare: every document is as likely
        return RankModel(np.zeros(d), np.ones(d), -1.0, 1.0, cut)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, _ = _columns(batch)
        return np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])

    mean, square = (_summed(rows.select("x", "y"), moments) / (good + bad)).reshape(2, d)
    scale = np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6
    w = fit_pairs(rows, scale)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_columns(batch)[0] / scale @ w)], names=["s"])

    scores = written(rows.select("x", "y").mapInArrow(scored, "s double"), "scores")
    place = min(bad - 1, good + bad - 2)
    threshold = (_ranked(scores, place) + _ranked(scores, place + 1)) / 2
    spread = scores.agg(F.stddev_pop("s")).first()[0]
    return RankModel(w, scale, float(threshold), max(float(spread) / 4, 1e-3), cut)


def labelled(labels: DataFrame, label: str, in_training: Column) -> DataFrame:
    """doc_id and y of all rows of training with a label of 0 or 1; of several labels of one id the greatest."""
    rows = labels.where(in_training & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    return rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))


def features(documents: DataFrame, keep: list[str]) -> DataFrame:
    def of(batch: pa.RecordBatch):
        for part, data, offsets in chunks(batch, "text"):
            x = document_stats(data, offsets)["x"]
            yield {c: part.column(c) for c in keep} | {"x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))}

    kinds = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(documents.select(*keep, "text"), of, f"{kinds}, x array<float>")


def train(documents: DataFrame, labels: DataFrame, in_training: Column, label: str = "quality", cut: float = 0.3) -> RankModel:
    """A RankModel of the whole texts of all labelled documents in training."""
    some = written(labelled(labels, label, in_training), "labels")
    rows = written(features(documents.select("doc_id", "text").join(some, "doc_id"), ["doc_id", "y"]), "features")
    blocks = -(-rows.count() // BLOCK) or 1
    return fit(rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))), cut)


def score_documents(documents: DataFrame, model: RankModel, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """`keep` columns (all of them by default) and the score of each row's whole text; a null text is empty."""
    keep = documents.columns if keep is None else keep
    rows = documents.select(*keep, *([] if "text" in keep else ["text"]))

    def of(batch: pa.RecordBatch):
        for part, data, offsets in chunks(batch, "text"):
            yield {c: part.column(c) for c in keep} | {out: model(document_stats(data, offsets)["x"]).astype(np.float64)}

    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(rows, of, f"{kinds}, `{out}` double")


def held_out(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text leaves no remainder by 5: never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null and empty texts get the score of a text without words; a null id is scored, not held out and
    never learned from. Without labels of both classes every score is above the cut. Rows may repeat;
    other columns (also one named score) are not read.
    """
    model = train(documents, labels, ~held_out(), cut=cut)
    return score_documents(documents, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
