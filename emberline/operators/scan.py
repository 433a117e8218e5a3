"""Running values of long ordered sequences, cell by cell.

The rows of a key are dealt by cells of their order (of time, say). Each cell is ordered in a task of its own; what
it needs of the cells before and behind it is one row of carried values. Those come from summaries of the cells,
put together in blocks of 1, 2, 4, ... cells: what lies before a cell is a few whole blocks, one for each set bit of
its number, found by an equi-join. No task ever sees all cells of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberline.sources.scratch import written


def joined_on(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], how: str) -> DataFrame:
    """a and the values of b of the rows with equal keys, null equal to null."""
    b = b.select(*[F.col(k).alias(f"_scan_key{i}") for i, k in enumerate(keys)], *[F.col(v).alias(f"_scan_of{v}") for v in values])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_scan_key{i}"))
    out = a.join(b, on, how)
    if how == "full":
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(f"_scan_key{i}")) for i, k in enumerate(keys)})
    return out.drop(*[f"_scan_key{i}" for i in range(len(keys))])


def scanned(rows: DataFrame, by: list[str], order: list[str], cell: Column, sums: dict[str, Column] | None = None, before: dict[str, Column] | None = None, after: dict[str, Column] | None = None) -> DataFrame:
    """rows with new columns, within each key `by` in the order of `order` (ascending, nulls first; it should be unique):
    `sums` up to and with the row, `before` and `after` the nearest value that is not null in the rows before or behind it.

    cell: a whole number that never falls along the order, so many rows of a key as one task can sort; null where the
    first column of the order is null. Null keys are a key of their own; an empty table gives an empty result. Columns
    of rows that begin with `_scan_` are not allowed; a new column takes the place of an old one of its name.
    """
    sums, before, after = sums or {}, before or {}, after or {}
    names = [f"_scan_{k}" for k in range(len(sums) + len(before) + len(after))]
    values = [*sums.values(), *before.values(), *after.values()]
    kinds = ["sum"] * len(sums) + ["before"] * len(before) + ["after"] * len(after)
    rows = rows.withColumns({"_scan_cell": cell.cast("long"), **dict(zip(names, values, strict=True))})
    place = F.struct(*order)

    def summed(name: str, kind: str) -> Column:
        if kind == "sum":
            return F.sum(name)
        return (F.max_by if kind == "before" else F.min_by)(name, F.when(F.col(name).isNotNull(), place))

    cells = written(rows.groupBy(*by, "_scan_cell").agg(*[summed(n, k).alias(n) for n, k in zip(names, kinds, strict=True)]), "cells")
    low, high = cells.agg(F.min("_scan_cell"), F.max("_scan_cell")).first()
    low, levels = low or 0, max(1, ((high or 0) - (low or 0) + 1).bit_length())
    number = F.coalesce(F.col("_scan_cell") - low + 1, F.lit(0))  # rows without a cell come first
    cells = cells.withColumn("_scan_cell", number)
    carried = _carried(cells, by, names, kinds, levels)

    inside = Window.partitionBy(*by, "_scan_cell").orderBy(*order)
    frame = {"sum": inside.rowsBetween(Window.unboundedPreceding, 0), "before": inside.rowsBetween(Window.unboundedPreceding, -1), "after": inside.rowsBetween(1, Window.unboundedFollowing)}
    within = {"sum": F.sum, "before": lambda n: F.last(n, ignorenulls=True), "after": lambda n: F.first(n, ignorenulls=True)}
    rows = rows.withColumn("_scan_cell", number)
    rows = rows.withColumns({n: within[k](n).over(frame[k]) for n, k in zip(names, kinds, strict=True)})
    rows = joined_on(rows, carried, [*by, "_scan_cell"], names, "left")
    out = {}
    for new, n, k in zip([*sums, *before, *after], names, kinds, strict=True):
        carry = F.col(f"_scan_of{n}")
        out[new] = F.coalesce(F.col(n), F.lit(0)) + F.coalesce(carry, F.lit(0)) if k == "sum" else F.coalesce(F.col(n), carry)
    kept = [c for c in rows.columns if not c.startswith("_scan_") and c not in out]
    return rows.select(*kept, *[v.alias(c) for c, v in out.items()])


def _carried(cells: DataFrame, by: list[str], names: list[str], kinds: list[str], levels: int) -> DataFrame:
    """For each cell the values that come into it: sums and last values of all cells before it, first values of all behind it."""
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_scan_level")
    of = F.expr("shiftright(_scan_cell, _scan_level)")

    def merged(name: str, kind: str, place: str) -> Column:
        there = F.when(F.col(name).isNotNull(), F.col(place))
        return F.sum(name) if kind == "sum" else (F.max_by if kind == "before" else F.min_by)(name, there)

    blocks = cells.select("*", level).withColumn("_scan_block", of)
    blocks = blocks.groupBy(*by, "_scan_level", "_scan_block").agg(*[merged(n, k, "_scan_cell").alias(n) for n, k in zip(names, kinds, strict=True)])
    found = None
    for side, wanted in (("before", ("sum", "before")), ("after", ("after",))):
        some = [(n, k) for n, k in zip(names, kinds, strict=True) if k in wanted]
        if not some:
            continue
        # before a cell: the block before its own on each level whose bit is set; behind it: the next one where it is not
        ask = cells.select(*by, "_scan_cell", level).withColumn("_scan_block", of + (-1 if side == "before" else 1))
        ask = ask.where((of % 2 == 1) if side == "before" else (of % 2 == 0)).where("_scan_block >= 0")
        joined = joined_on(ask, blocks, [*by, "_scan_level", "_scan_block"], [n for n, _ in some], "inner")
        joined = joined.withColumnsRenamed({f"_scan_of{n}": n for n, _ in some}).withColumn("_scan_place", F.expr("shiftleft(_scan_block, _scan_level)"))
        one = joined.groupBy(*by, "_scan_cell").agg(*[merged(n, k, "_scan_place").alias(n) for n, k in some])
        found = one if found is None else joined_on(found, one, [*by, "_scan_cell"], [n for n, _ in some], "full").withColumnsRenamed({f"_scan_of{n}": n for n, _ in some})
    return found


def time_cell(time: str, width_s: float = 3600.0) -> Column:
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / int(width_s * 1_000_000))
