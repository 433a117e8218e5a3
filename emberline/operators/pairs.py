"""Exact medians over all pairs of a cluster, in bounded memory and without a row for each pair."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.sources.scratch import written

#: Rows of a cluster up to which its pairs are joined; pairs of a cluster that are looked at in one pass (as many as it has
#: rows, within these two); times of one place in one list; distances that a task takes, about; pairs that are held at a
#: time; rows that are met at a time; one row of how many meets a list in a pass that estimates.
JOINED, LOOKED_AT, LOOKED_AT_MOST, LIST, DISTANCES, AT_ONCE, CHUNK, THIN = 256, 200_000, 4_000_000, 65_536, 200_000_000, 2_000_000, 32_768, 16
_FAR = 1 << 60
_STATE = "cid long, n long, lo double, hi double, share double, looked long, drawn boolean, thin long"


def _limits(d: np.ndarray, lo: float, hi: float) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest difference of times (microseconds) of pairs d apart with a speed in lo .. hi, a little
    more of both: what is out of it is slower or faster for certain."""
    with np.errstate(all="ignore"):
        least = np.floor(d * 1e6 / hi * (1 - 1e-9)) - 1 if hi else np.where(d > 0, np.inf, 1.0)
        most = np.ceil(d * 1e6 / lo * (1 + 1e-9)) + 1 if lo else np.full(len(d), np.inf)
    return np.clip(np.nan_to_num(least, nan=1.0, posinf=_FAR), 1, _FAR).astype(np.int64), np.clip(np.nan_to_num(most, nan=_FAR, posinf=_FAR), 1, _FAR).astype(np.int64)


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often they are found."""
    values, where = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
    return values, np.bincount(where, np.concatenate([k for _, k in found]), len(values)).astype(np.int64)


class _Side:
    """Lists of a block one after the other: places, and rows in the order of list and time with how often they are."""

    def __init__(self, lists: pd.DataFrame, place: list[str]):
        self.places = lists[place].to_numpy(float)
        self.sizes = np.array([len(x) for x in lists.times], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.at = np.repeat(np.arange(len(lists)), self.sizes)
        self.t, self.w = (np.concatenate([np.asarray(x, np.int64) for x in c]) for c in (lists.times, lists.weights))

    def lists(self):
        """Place, times, and the weights before each row and after the last of every list."""
        for here, size, end in zip(self.places, self.sizes, self.ends, strict=True):
            yield here, self.t[end - size : end], np.concatenate([[0], np.cumsum(self.w[end - size : end])])


def _drawn(one: _Side, two: _Side, same: bool, share: float, random: np.random.Generator, distance: Callable):
    """Speeds of pairs at random, `share` of those of two blocks."""
    ends = [np.cumsum(side.w) for side in (one, two)]
    pairs = float(ends[0][-1]) * float(ends[1][-1]) / (2 if same else 1)
    some = int(random.poisson(share * pairs))
    for begin in range(0, some, AT_ONCE):
        size = min(AT_ONCE, some - begin)
        i, j = (np.searchsorted(e, random.integers(0, e[-1], size), "right") for e in ends)
        apart = np.abs(one.t[i] / 1e6 - two.t[j] / 1e6)
        i, j, apart = i[apart > 0], j[apart > 0], apart[apart > 0]
        d = distance(list(one.places[one.at[i]].T), list(two.places[two.at[j]].T))
        yield d / apart, np.ones(len(d))


def _counted(one: _Side, two: _Side, same: bool, lo: float, hi: float, share: float, thin: int, random: np.random.Generator, distance: Callable, counts: dict):
    """Speeds of a share of the pairs of two blocks in lo .. hi and how often each is met; adds to `counts` how many pairs are slower
    than lo, how many lie in lo .. hi, and how many of those are of unlike rows. With `thin` these are estimates of one row of so many,
    two rows of each 2 * thin in the order of list and time, with a start of its own for each list, and `spread` is the variance of `slower`."""
    own = [(here, t, np.append(t, 4 * _FAR - 1), np.concatenate([[-2 * _FAR], t]), before) for here, t, before in one.lists()]
    share = share if thin == 1 else min(1.0, share * thin)
    whole = share >= 1 and thin == 1
    for begin in range(0, len(two.t), CHUNK * thin):
        all_t, all_w, all_at = (x[begin : begin + CHUNK * thin] for x in (two.t, two.w, two.at))
        first = int(all_at[0])
        all_at = all_at - first
        many, sizes = list(two.places[first : first + int(all_at[-1]) + 1].T), np.bincount(all_at)
        t, w, at = all_t, all_w, all_at
        for here, times, ahead, behind, before in own:
            d = distance(here, many)
            least, most = _limits(d, lo, hi)
            if thin == 1:
                least, most = np.repeat(least, sizes), np.repeat(most, sizes)
            else:
                starts = random.integers(0, 2 * thin, 2)
                t, w, at = (np.concatenate([x[start :: 2 * thin] for start in starts]) for x in (all_t, all_w, all_at))
                least, most = least[at], most[at]
            # later ones of this list; the earlier ones of a block's own pairs are met the other way round
            low = np.searchsorted(times, t + least)
            near = np.flatnonzero(ahead.take(low) <= t + most)
            slower = before[-1] - before.take(low)
            ranges = [(near, low[near], np.searchsorted(times, (t + most)[near], "right"))]
            if not same:
                high = np.searchsorted(times, t - least, "right")
                near = np.flatnonzero(behind.take(high) >= t - most)
                slower += before.take(high)
                ranges.append((near, np.searchsorted(times, (t - most)[near]), high[near]))
            for near, low, high in ranges:
                slower[near] -= before.take(high) - before.take(low)
            counts["slower"] += thin * int(np.dot(w, slower))
            if thin > 1:
                half = len(all_t[starts[0] :: 2 * thin])
                counts["spread"] += float(thin * (np.dot(w[:half], slower[:half]) - np.dot(w[half:], slower[half:]))) ** 2
            for near, low, high in ranges:
                if not len(near):
                    continue
                k, often = high - low, w[near] * (before.take(high) - before.take(low))
                inside = int(often.sum())
                counts["inside"] += thin * inside
                counts["unlike"] += thin * int(k.sum())
                ends = np.cumsum(k if whole else often)
                some = int(ends[-1]) if whole else int(random.poisson(share * inside))
                for start in range(0, some, AT_ONCE):
                    size = min(AT_ONCE, some - start)
                    pick = np.arange(start, start + size) if whole else random.integers(0, ends[-1], size)
                    j = np.searchsorted(ends, pick, "right")
                    if whole:
                        i = high[j] + pick - ends[j]
                    else:  # a pair as often as its rows are
                        i = np.searchsorted(before, before[low[j]] + (pick - ends[j] + often[j]) // w[near[j]], "right") - 1
                    j = near[j]
                    speed = d[at[j]] / np.abs(times[i] / 1e6 - t[j] / 1e6)
                    yield speed, w[j] * (before[i + 1] - before[i]) if whole else np.ones(size)


def _met(place: list[str], distance: Callable, turn: int):
    """Of the lists of two blocks of a cluster: how many pairs are slower than lo, how many lie in lo .. hi, and a share of those."""

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        cid, lo, hi, share, same = int(first.cid), float(first.lo), float(first.hi), float(first.share), bool(first.a == first.c)
        one, two = pdf[pdf.block == first.a], pdf[pdf.block == first.c]
        counts = {"slower": 0, "inside": 0, "unlike": 0, "spread": 0.0}
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        if len(one) and len(two):
            random = np.random.default_rng([cid & (2**63 - 1), int(first.a), int(first.c), turn])
            one, two = _Side(one, place), _Side(two, place)
            if len(one.places) * len(two.t) > len(two.places) * len(one.t):
                one, two = two, one
            speeds = _drawn(one, two, same, share, random, distance) if first.drawn else _counted(one, two, same, lo, hi, share, int(first.thin), random, distance, counts)
            for pair in speeds:
                found.append(pair)
                held += len(pair[0])
                if held > AT_ONCE:
                    found = [_merged(found)]
                    held = 0
        values, often = _merged(found) if found else (np.zeros(0), np.zeros(0, np.int64))
        row = {"cid": cid, "n": int(first.n), "lo": lo, "hi": hi, "share": share, "looked": int(first.looked), "drawn": bool(first.drawn), "thin": int(first.thin), **counts, "values": values, "counts": often}
        return pd.DataFrame({k: [v] for k, v in row.items()})

    return met


def _narrowed(pdf: pd.DataFrame) -> pd.DataFrame:
    """The median of a cluster, or the range of speeds that the next pass looks at. The range is chosen by a sample; how many pairs
    are below it is counted, so a range that misses the median is noticed, and all is looked at."""
    first = pdf.iloc[0]
    n, lo, hi, share, looked, speed, done = int(first.n), float(first.lo), float(first.hi), float(first.share), int(first.looked), math.nan, True
    slower, inside, unlike = (int(pdf[c].sum()) for c in ("slower", "inside", "unlike"))
    thin = int(first.thin) if first.drawn else 1
    estimated = first.thin > 1 and not first.drawn
    if first.drawn:  # of all pairs
        inside = unlike = n
    low, high = (n - 1) // 2 - slower, n // 2 - slower  # the places of the median's two values in the range
    values, counts = _merged(list(zip(pdf["values"], pdf["counts"], strict=True)))
    ends = np.cumsum(counts)
    if n == 0:
        pass
    elif estimated and (low < 0 or high >= inside or not len(values) or lo == hi):  # the same range again, counted
        done, share = False, min(1.0, looked / max(inside, 1))
    elif low < 0 or high >= inside or not len(values):  # missed
        thin = 1
        done, lo, hi, share = False, 0.0, math.inf, min(1.0, looked / n)
        if (float(first.lo), float(first.hi)) == (lo, hi):  # a sample of no pair at all
            share = 1.0
    elif lo == hi:
        speed = lo
    elif share >= 1 and not estimated:
        speed = float((values[np.searchsorted(ends, low, "right")] + values[np.searchsorted(ends, high, "right")]) / 2)
    else:
        done, m = False, int(ends[-1])
        wide = 2.5 * math.sqrt(m) + 2  # five standard errors
        off = 6 * math.sqrt(pdf.spread.sum()) if estimated else 0.0
        i, j = (low - off) / inside * m - wide, (high + off) / inside * m + wide
        if i >= 0:
            lo = float(values[np.searchsorted(ends, i, "right")])
        if j < m:
            hi = float(values[np.searchsorted(ends, j, "right")])
        hi = math.inf if math.isnan(hi) else hi
        i, j = np.searchsorted(values, lo), np.searchsorted(values, hi, "right")
        left = inside * counts[i:j].sum() / m
        # a range as full as before is of few values: they are counted
        few = left * unlike / inside <= looked or left > inside / 2 and lo < hi
        share = 1.0 if few else min(1.0, looked / max(left, 1.0))
        thin = 1 if few else thin
    return pd.DataFrame([{"cid": int(first.cid), "n": n, "lo": lo, "hi": hi, "share": share, "looked": looked, "drawn": False, "thin": thin, "speed": speed, "done": done}])


def median_speed(rows: DataFrame, place: list[str], distance: Callable, least: int = 2) -> DataFrame:
    """cid and speed, the exact median over all pairs of a cluster's rows of distance by time, pairs of equal times left out (null if
    there are no others); of clusters of `least` rows or more. rows: cid, group_id, t (microseconds) and the columns of place.
    distance(a place, columns of places) takes numpy arrays, and columns of places on both sides.

    Rows of one place and time are one row with a weight, and those of one place a list of times: the pairs of a list and a row that
    are faster than a value are a range of the list. So a pass takes a distance for each row and place, not for each pair, counts the
    pairs below and in a range of speeds, and looks at a share of those in it. The first range is that of pairs drawn at random; it
    narrows by a sample of itself until all its pairs can be looked at, in a large cluster by estimates at first.
    """
    here = ["cid", *place]
    rows = written(rows.dropna(subset=["cid", "t", *place]).groupBy(*here, "t").agg(F.count("*").alias("w")), "rows")
    times = rows.groupBy("cid", "t").agg(F.sum("w").alias("w"), F.count("*").alias("k"))
    half = lambda c: F.expr(f"{c} * ({c} - 1) div 2")
    pairs = times.groupBy("cid").agg(F.sum("w").alias("w"), F.sum("k").alias("k"), F.sum(half("w")).alias("_same")).where(F.col("w") >= least)
    pairs = written(pairs.select("cid", "w", "k", half("w").alias("pairs"), (half("w") - F.col("_same")).alias("n")), "pairs")
    rows = rows.join(pairs.select("cid"), "cid")
    lists = rows.groupBy(*here).agg(F.ceil(F.count("*") / LIST).alias("_lists"))
    rows = rows.join(lists, here).withColumn("_list", F.pmod(F.xxhash64("t"), F.col("_lists")))
    rows = rows.groupBy(*here, "_list").agg(F.sort_array(F.collect_list(F.struct("t", "w"))).alias("_rows"))
    places = written(rows.select(*here, "_list", F.col("_rows.t").alias("times"), F.col("_rows.w").alias("weights")), "places")
    blocks = F.ceil(F.greatest(F.sqrt(F.col("p") * F.col("k") / DISTANCES), F.col("k") / (16 * LIST))).cast("long")
    sizes = places.groupBy("cid").agg(F.count("*").alias("p")).join(pairs, "cid").withColumn("blocks", blocks)
    sizes = written(sizes, "sizes")
    looked = F.greatest(F.lit(LOOKED_AT), F.least("w", F.lit(LOOKED_AT_MOST))).cast("long")
    many = F.col("n") > looked
    drawn = many & (F.col("n") >= F.col("pairs") / 16)  # unless most pairs are of equal times
    # estimates first where the pairs left by two samples, 25 / looked of all, are more than one pass looks at
    left = F.col("k").cast("double") * F.col("k") / 2 * 25 / looked
    thin = F.when(drawn & (F.col("blocks") > 1) & (left > looked), THIN).otherwise(1).cast("long")
    state = sizes.select("cid", "n", F.lit(0.0).alias("lo"), F.lit(float("inf")).alias("hi"), F.when(many, looked / F.col("n")).otherwise(1.0).alias("share"), looked.alias("looked"), drawn.alias("drawn"), thin.alias("thin"))
    dealt = places.join(sizes.select("cid", "blocks"), "cid").withColumn("block", F.pmod(F.xxhash64(*place, "_list"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"a": F.least("block", "other"), "c": F.greatest("block", "other")}).select(*here, "times", "weights", "block", "a", "c")
    # few bytes are much work: a task for each pair of blocks, where they are not very many
    met = sizes.agg(F.sum(F.expr("blocks * (blocks + 1) div 2"))).first()[0] or 0
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(4 * met, 1024))
    done = []
    for turn in count():
        if state.isEmpty():
            break
        some = dealt.join(state, "cid").repartition(tasks, "cid", "a", "c").groupBy("cid", "a", "c")
        some = some.applyInPandas(_met(place, distance, turn), _STATE + ", slower long, inside long, unlike long, spread double, values array<double>, counts array<long>")
        step = written(some.groupBy("cid").applyInPandas(_narrowed, _STATE + ", speed double, done boolean"), "medians")
        done.append(step.where("done").select("cid", F.nanvl("speed", F.lit(None).cast("double")).alias("speed")))
        state = step.where("not done").drop("done", "speed")
    return reduce(DataFrame.unionByName, done) if done else state.select("cid", F.lit(None).cast("double").alias("speed"))
