"""Exact splits, balanced samples and weighted draws, by ranks and running sums over a seeded order.

No group is ordered in one task: ranks and sums come from running values over cells of the order. `order` is a
whole number by row that looks random; by default a seeded 64-bit hash of the key. `cell` is a whole number that never
falls along the order, by default the top bits of the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import scanned


def _ordered(df: DataFrame, key: str, seed: int, order: Column | None, cell: Column | None) -> tuple[DataFrame, Column]:
    if order is not None and cell is None:
        raise ValueError("an order of one's own needs cells")
    df = df.withColumn("_order", F.xxhash64(F.lit(seed), key) if order is None else order)
    return df, F.shiftright("_order", 52) if cell is None else cell


def split(df: DataFrame, key: str, ratios: dict[str, float], seed: int = 0, order: Column | None = None, cell: Column | None = None) -> DataFrame:
    """df with `part`: the first int(n * ratio) rows of the order are the first part, and so on; the last one takes the rest.
    key is unique. An empty table gives an empty result."""
    rows, cell = _ordered(df, key, seed, order, cell)
    rows = scanned(rows, [], ["_order", key], cell, sums={"_rank": F.lit(1)})
    n = df.count()
    part, upper = F.lit(list(ratios)[-1]), 0
    bounds = []
    for name, ratio in list(ratios.items())[:-1]:
        upper += int(n * ratio)
        bounds.append((name, upper))
    for name, upper in reversed(bounds):
        part = F.when(F.col("_rank") <= upper, name).otherwise(part)
    return rows.withColumn("part", part).drop("_order", "_rank")


def rebalanced(df: DataFrame, positive: Column, ratio: float, key: str, seed: int = 0, order: Column | None = None, cell: Column | None = None) -> DataFrame:
    """All positive rows and the first round(P / ratio) - P of the others in the order, so that positives are `ratio` of the rows; all of
    them if there are fewer. Rows whose `positive` is null count as not positive."""
    yes = F.coalesce(positive, F.lit(False))
    rows, cell = _ordered(df.withColumn("_yes", yes), key, seed, order, cell)
    p = df.agg(F.count_if(yes)).first()[0]
    wanted = max(0, round(p / ratio) - p)
    rows = scanned(rows, ["_yes"], ["_order", key], cell, sums={"_rank": F.lit(1)})
    return rows.where(F.col("_yes") | (F.col("_rank") <= wanted)).drop("_yes", "_order", "_rank")


#: Whole parts of a weight that is the sum of all weights.
UNITS = 10**12


def drawn(df: DataFrame, weight: str, n: int, key: str, seed: int = 0, order: Column | None = None, cell: Column | None = None) -> DataFrame:
    """n rows of df drawn with replacement in proportion to `weight`, with `draw`, their number from 0, by systematic sampling: marks stand
    evenly on the running sum of the weights, the first at a place that the seed gives, and a row is drawn once for each mark on its stretch.

    Weights are rounded to 10^-12 of their sum, so a row's draws differ by less than one from n * weight / sum. Null and negative weights are never drawn;
    if no weight is above zero the result is empty."""
    total = df.agg(F.sum(F.greatest(F.coalesce(F.col(weight), F.lit(0.0)).cast("double"), F.lit(0.0)))).first()[0] or 0.0
    if total <= 0 or n <= 0:
        return df.where("false").withColumn("draw", F.lit(0).cast("long"))
    units = F.round(F.greatest(F.coalesce(F.col(weight), F.lit(0.0)).cast("double"), F.lit(0.0)) / total * UNITS).cast("long")
    rows, cell = _ordered(df.withColumn("_units", units), key, seed, order, cell)
    rows = scanned(rows, [], ["_order", key], cell, sums={"_upto": F.col("_units")})
    all_units = rows.agg(F.sum("_units")).first()[0]
    offset = (seed * 104729 + 7919) * 1_000_003 % all_units
    mark = lambda c: F.expr(f"CAST((CAST({c} AS DECIMAL(38, 0)) * {n} + {offset}) div {all_units} AS LONG)")
    rows = rows.withColumns({"_a": mark("(_upto - _units)"), "_b": mark("_upto")}).where("_b > _a")
    return rows.withColumn("draw", F.explode(F.sequence(F.col("_a"), F.col("_b") - 1))).drop("_order", "_units", "_upto", "_a", "_b")
