"""Scores: states, de-emphasis, precision and recall, data sets for learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Belief by human confidence word.
HUMAN_SCORES = {"rejected": 0.25, "low": 0.5, "medium": 0.75, "high": 0.95, "auto": 0.9}


def human_score(word: Column) -> Column:
    out = F.lit(-1.0)
    for k, v in HUMAN_SCORES.items():
        out = F.when(word == k, v).otherwise(out)
    return out


def triage_state(score: Column, threshold: float, forced: Column) -> Column:
    return F.when(forced, "accepted").when(score.isNull(), "N/A").when(score < threshold, "rejected").otherwise("accepted")


def validation_state(score: Column, low: float, high: float, forced: Column) -> Column:
    return F.when(forced & (score.isNull() | (score < high)), "candidate").when(score.isNull(), "N/A").when(score < low, "rejected").when(score < high, "candidate").otherwise("accepted")


def deemphasis(distances: Column, radii: list[float], alphas: list[float]) -> Column:
    """alpha of the first spot whose radius holds the distance, else 0."""
    out = F.lit(0.0)
    for k in range(len(radii) - 1, -1, -1):
        out = F.when(F.element_at(distances, k + 1) <= radii[k], alphas[k]).otherwise(out)
    return out


def belief(opinions: DataFrame, source: str) -> DataFrame:
    """One belief a subject: the mean of its machine opinions, or its only human one (several are an error)."""
    rows = opinions.where(F.col("source") == source)
    if source == "human":
        once = F.assert_true(F.count("*") == 1, F.lit("several human opinions of one subject"))
        return rows.groupBy("subject").agg((F.max("belief") + F.when(once.isNull(), 0.0)).alias("belief"))
    return rows.groupBy("subject").agg(F.avg("belief").alias("belief"))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """tp, fp, fn, precision (-1 if nothing is accepted) and recall of (score, is_true)."""
    yes = F.col("score") >= threshold
    out = scored.agg(F.count_if(yes & F.col("is_true")).alias("tp"), F.count_if(yes & ~F.col("is_true")).alias("fp"), F.count_if(~yes & F.col("is_true")).alias("fn"))
    return out.select("tp", "fp", "fn", F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(-1.0).alias("precision"), (F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))).alias("recall"))


def sweep(scored: DataFrame, steps: int, low: float, false_share: float = 1.0) -> DataFrame:
    """tp, found, precision and recall at `steps` thresholds from low to 1. Scores are first counted by
    the thresholds they reach, so the sweep sees `steps` rows, not the data."""
    width = (1.0 - low) / (steps - 1)
    reach = F.floor(F.round((F.col("score") - low) / width, 9)).cast("int")
    counts = scored.where(F.col("score") >= low).groupBy(F.least(reach, F.lit(steps - 1)).alias("k")).agg(F.count_if("is_true").alias("t"), F.count_if(~F.col("is_true")).alias("f"))
    total = scored.agg(F.count_if("is_true").alias("possible"))
    grid = scored.sparkSession.range(steps).select(F.col("id").cast("int").alias("k"))
    above = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)  # `steps` rows
    out = grid.join(counts, "k", "left").select("k", F.sum(F.coalesce("t", F.lit(0))).over(above).alias("tp"), F.sum(F.coalesce("f", F.lit(0))).over(above).alias("fp"))
    p = F.col("tp") / F.nullif(F.col("tp") + F.col("fp") / false_share, F.lit(0.0))
    return out.crossJoin(F.broadcast(total)).select(F.round(low + F.col("k") * width, 9).alias("threshold"), "tp", (F.col("tp") + F.col("fp")).alias("found"), F.when(p.between(0, 1), p).alias("precision"), (F.col("tp") / F.nullif(F.col("possible"), F.lit(0))).alias("recall"))


def curve(scored: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, in descending order. Scores are counted first; the
    running sums are over distinct scores (round them to bound their number)."""
    counts = scored.groupBy("score").agg(F.count_if("is_true").alias("t"), F.count("*").alias("n"))
    w = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.select("score", F.sum("t").over(w).alias("tp"), F.sum("n").over(w).alias("found"))
    total = scored.agg(F.count_if("is_true").alias("possible"))
    return rows.crossJoin(F.broadcast(total)).select("score", "tp", "found", (F.col("tp") / F.col("found")).alias("precision"), (F.col("tp") / F.nullif(F.col("possible"), F.lit(0))).alias("recall"))


def curves_by(scored: DataFrame, key: str) -> DataFrame:
    """The curve of each key's rows: key, score, precision, recall."""
    counts = scored.groupBy(key, "score").agg(F.count_if("is_true").alias("t"), F.count("*").alias("n"))
    w = Window.partitionBy(key)
    above = w.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.select(key, "score", F.sum("t").over(above).alias("tp"), F.sum("n").over(above).alias("found"), F.sum("t").over(w).alias("possible"))
    return rows.select(key, "score", (F.col("tp") / F.col("found")).alias("precision"), (F.col("tp") / F.nullif(F.col("possible"), F.lit(0))).alias("recall"))


def average_precision(points: DataFrame, recall_limit: float | None = None) -> DataFrame:
    """Sum of precision times the step in recall over a curve. With a limit only over the points whose recall is
    above that of the point nearest the limit (the curve ends at recall 0), as a share of 1 - limit."""
    w = Window.orderBy(F.col("score").desc())
    rows = points.withColumns({"_r": F.lag("recall").over(w), "_s": F.lag("score").over(w)})
    if recall_limit is None:
        return rows.agg(F.sum((F.col("recall") - F.coalesce("_r", F.lit(0.0))) * F.col("precision")).alias("average_precision"))
    off = F.round(F.abs(F.col("recall") - recall_limit), 12)
    nearest = points.agg(F.min(F.struct(off.alias("off"), "score")).alias("_c"))
    end = F.when(F.col("_c.off") <= recall_limit, F.col("_c.score")).otherwise(float("inf"))
    step = F.when(F.col("_s") < end, (F.col("recall") - F.col("_r")) * F.col("precision")).otherwise(0.0)
    return rows.crossJoin(F.broadcast(nearest)).agg((F.sum(step) / (1.0 - recall_limit)).alias("average_precision"))


def recall_at_precision(points: DataFrame, target: float) -> DataFrame:
    """Mean, least and largest recall where the precision crosses the target; 0 if it never does."""
    w = Window.orderBy(F.col("score").desc())
    rows = points.withColumns({"_p": F.lag("precision").over(w), "_r": F.lag("recall").over(w)})
    crossing = (F.col("_p") - target) * (F.col("precision") - target) <= 0
    mean = (F.col("_r") + F.col("recall")) / 2
    out = rows.where(F.col("_p").isNotNull() & crossing)
    return out.agg(F.coalesce(F.avg(mean), F.lit(0.0)).alias("recall"), F.coalesce(F.min(mean), F.lit(0.0)).alias("least"), F.coalesce(F.max(mean), F.lit(0.0)).alias("most"))


def f_beta(scored: DataFrame, threshold: float, beta: float) -> DataFrame:
    c = confusion(scored, threshold)
    b = beta * beta
    return c.select(((1 + b) * F.col("tp") / F.nullif((1 + b) * F.col("tp") + b * F.col("fn") + F.col("fp"), F.lit(0.0))).alias("f_beta"))


def scaled(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns scaled as minmax, robust (median and quartiles) or standard (mean and population deviation).
    What is learned are a few numbers a column."""
    exprs = []
    for c, kind in kinds.items():
        exprs += {"minmax": [F.min(c), F.max(c) - F.min(c)], "robust": [F.median(c), F.percentile(c, F.lit(0.75)) - F.percentile(c, F.lit(0.25))], "standard": [F.avg(c), F.stddev_pop(c)]}[kind]
    stats = df.agg(*[e.alias(f"_s{i}") for i, e in enumerate(exprs)])
    out = df.crossJoin(F.broadcast(stats))
    names = list(kinds)
    return out.select(*[c for c in df.columns if c not in kinds], *[((F.col(c) - F.col(f"_s{2 * i}")) / F.coalesce(F.nullif(F.col(f"_s{2 * i + 1}").cast("double"), F.lit(0.0)), F.lit(1.0))).alias(c) for i, c in enumerate(names)])


def sample_weights(df: DataFrame, energy: str, positive: Column, most: float = 20.0, negative: float = 0.5) -> DataFrame:
    """weight: (energy / median energy of the positives)^2 up to `most`; a constant for negatives."""
    centre = df.where(positive).agg(F.median(energy).alias("_m"))
    w = F.least(F.pow(F.col(energy) / F.col("_m"), 2), F.lit(most))
    return df.crossJoin(F.broadcast(centre)).withColumn("weight", F.when(positive, w).otherwise(negative)).drop("_m")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """1 / class size, so that the weights of all rows add up to one."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    classes = sizes.agg(F.count("*").alias("_k"))
    return df.join(F.broadcast(sizes), label).crossJoin(F.broadcast(classes)).withColumn("weight", 1 / (F.col("_n") * F.col("_k"))).drop("_n", "_k")
