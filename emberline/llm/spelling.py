"""Spelling variants: words one edit apart, found by two-dimensional range reporting.

A word that differs from w at position i alone has the prefix w[:i] and the suffix behind i. In the forward
order of all words the first are an interval, in the reverse order the second are one, and a wavelet tree over
the reverse ranks in forward order reports the words in both. Words meet where an edit could lie between them:
an edit in one half leaves the other half as it is, so they are dealt by the half that stays, and groups that
are still large by smaller parts, down to one position. No task holds more than its groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from emberline.session import find_package

from .common import written

LETTERS = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a group beyond which its words are dealt by smaller parts.
GROUP_ROWS = 20_000
#: Rows of many groups that a task takes at a time, and rectangles that are reported at a time.
BLOCK_ROWS, BLOCK_RECTANGLES = 60_000, 1 << 20


def word_counts(documents: DataFrame, deletion: int | None = None, shortest: int = 7) -> DataFrame:
    """word, n: maximal runs of letters, A-Z in lower case, of at least `shortest` code points, and how often each is there.

    With `deletion`, a run loses a letter where `deletion` divides the crc32 h of `<doc_id>:<run>`: the one at h modulo its
    length. A null text has no words; a null id is the empty string there. Ids may repeat; other columns are not read.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0)))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    word = rows.withColumn("word", F.translate("run", _UPPER, _LOWER))
    if deletion:
        h, size = F.col("h"), F.char_length("word")
        word = word.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (h % size).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, size))
        word = word.select(F.when(h % deletion == 0, shorter).otherwise(F.col("word")).alias("word")).where(F.char_length("word") >= shortest)
    return word.groupBy("word").agg(F.count("*").alias("n"))


class WaveletTree:
    """A permutation's values by position, bit by bit from the highest: which values of a range stand in a range of positions."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros, self.below = [], []
        for level in range(self.bits - 1, -1, -1):
            one = (values >> level) & 1 == 1
            count = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~one, out=count[1:])
            self.below.append(count)  # zeros before a position
            self.zeros.append(int(count[-1]))
            values = np.concatenate([values[~one], values[one]])

    def report(self, start: np.ndarray, stop: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) of all values in [least, most) at positions [start, stop)."""
        query, node = np.arange(len(start)), np.zeros(len(start), np.int64)
        for k in range(self.bits):
            width = 1 << (self.bits - 1 - k)
            below, zeros = self.below[k], self.zeros[k]
            start0, stop0 = below[start], below[stop]
            left = (start0 < stop0) & (least < node + width)
            start1, stop1 = zeros + start - start0, zeros + stop - stop0
            right = (start1 < stop1) & (most > node + width)
            lows, highs = np.flatnonzero(left & (most > node)), np.flatnonzero(right & (least < node + 2 * width))
            both = np.concatenate([lows, highs])
            start, stop = np.concatenate([start0[lows], start1[highs]]), np.concatenate([stop0[lows], stop1[highs]])
            node = np.concatenate([node[lows], node[highs] + width])
            query, least, most = query[both], least[both], most[both]
        return query, node


def _runs(common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of an order, the interval around it whose neighbours all share `least` characters or more."""
    first = np.flatnonzero(common < least)
    run = np.cumsum(common < least) - 1
    return first[run], np.append(first[1:], len(common))[run]


def _ordered(chars: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of (group, characters), and in that order how many characters each row shares with the one before; -1 across groups."""
    key = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), np.ascontiguousarray(chars).view(np.uint8).reshape(len(chars), -1)], axis=1)
    order = np.argsort(np.ascontiguousarray(key).view(f"S{key.shape[1]}").ravel(), kind="stable")
    if len(order) == 1:
        return order, np.array([-1])
    a, g = chars[order], group[order]
    differ = a[1:] != a[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), chars.shape[1])
    return order, np.append(-1, np.where(g[1:] == g[:-1], common, -1))


def _near(chars: np.ndarray, group: np.ndarray, lo: np.ndarray, hi: np.ndarray, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows (each in both directions) one edit apart, found in their group at positions lo .. hi of the shorter word, and the
    rows' places in code-point order. chars: a row a word of `short` characters or one more, zeros behind it."""
    m = len(group)
    long = chars[:, short] > 0
    forward, f_common = _ordered(chars, group)
    backward = np.where(long[:, None], chars[:, ::-1], np.roll(chars[:, ::-1], -1, axis=1))
    reverse, r_common = _ordered(backward, group)
    f_at, r_at = np.empty(m, np.int64), np.empty(m, np.int64)
    f_at[forward], r_at[reverse] = np.arange(m), np.arange(m)
    found = []
    for longer in (False, True):
        chosen = long == longer
        if not chosen.any():
            continue
        # counts of the chosen words before each place of both orders, and the tree over them
        f_before = np.concatenate([[0], np.cumsum(chosen[forward])])
        r_before = np.concatenate([[0], np.cumsum(chosen[reverse])])
        tree = WaveletTree(r_before[r_at[forward[chosen[forward]]]])
        by_value = reverse[chosen[reverse]]
        query: list[np.ndarray] = []
        held = 0

        def reported(parts: list, tree=tree, by_value=by_value, longer=longer) -> None:
            row, at, *box = (np.concatenate(x) for x in zip(*parts, strict=True))
            which, value = tree.report(*box)
            a, b, at = row[which], by_value[value], at[which]
            keep = chars[a, at] != chars[b, at]  # not the word itself; of several places of an inserted letter the last
            found.append((a[keep], b[keep]))
            if longer:
                found.append((b[keep], a[keep]))

        least, most = int(lo.min()), int(hi.max())
        for i in range(least, most + longer):
            f_start, f_stop = _runs(f_common, i)
            r_start, r_stop = _runs(r_common, short - i - (not longer))
            row = np.flatnonzero(~long & (lo <= i) & ((i < hi) | ((hi == short) & (i == short))))
            box = [f_before[f_start[f_at[row]]], f_before[f_stop[f_at[row]]], r_before[r_start[r_at[row]]], r_before[r_stop[r_at[row]]]]
            more = 0 if longer else 1  # a word of the same length meets itself
            live = (box[1] - box[0] > more) & (box[3] - box[2] > more)
            if live.any():
                query.append((row[live], np.full(int(live.sum()), i), *(x[live] for x in box)))
                held += int(live.sum())
            if held > BLOCK_RECTANGLES or query and i == most + longer - 1:
                reported(query)
                query, held = [], 0
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), f_at
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]), f_at


def _characters(words: list[str], width: int) -> np.ndarray:
    """One row a word: its code points, zeros behind them."""
    points = np.array(words, f"U{width}").view("<u4").reshape(-1, width)
    return points.astype(np.uint8 if points.max(initial=0) < 256 else ">u4")


def _block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """What the groups of a block say of each of their rows: near words, and the best of them."""
    key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "short", "lo", "hi")])
    new = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
    group = np.cumsum(new) - 1
    company = np.flatnonzero(np.bincount(group)[group] > 1)
    _, short, lo, hi = key[:, company]
    counts = batch.column("n").to_numpy()
    for size in np.unique(short).tolist():
        rows = company[short == size]
        words = batch.column("word").take(pa.array(rows)).to_pylist()
        chars = _characters(words, size + 1)
        yield from _summed(words, counts[rows], *_near(chars, group[rows], lo[short == size], hi[short == size], size))


def _summed(words: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        order = np.lexsort((place[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        near = np.diff(np.append(first, len(a)))
        yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in a[first].tolist()]), pa.array(near), pa.array(n[b[first]]), pa.array([words[i] for i in b[first].tolist()])], schema=_OUT)


_FOUND = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()), T.StructField("best_n", T.LongType()), T.StructField("best", T.StringType())])
_OUT = to_arrow_schema(_FOUND)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups, as many as make up a block; rows come ordered by group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= BLOCK_ROWS:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = rows.column("key").to_numpy()
            last = int(np.flatnonzero(np.append(True, key[1:] != key[:-1]))[-1])
            if last:
                yield from _block(rows.slice(0, last))
            held = [rows.slice(last)]
    rows = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
    for batch in rows[:1]:
        yield from _block(batch)


def _dealt(words: DataFrame, shortest: int, group_rows: int) -> DataFrame:
    """word, n, short, lo, hi, key: every word in the groups where a word one edit away can be: as the shorter or equal word of its own
    length and as the longer one of the length below, by what stays the same if the edit lies at lo .. hi of the shorter word."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.filter(F.array(size, size - 1), lambda x: x >= shortest)).alias("short"))
    halves = F.expr("array(struct(0 AS lo, short div 2 AS hi), struct(short div 2 AS lo, short AS hi))")
    rows = rows.select("*", F.inline(halves)).select("word", "n", "short", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))
    key = F.xxhash64("short", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), F.substring("word", F.col("hi") + 1 + size - F.col("short"), size))
    rows = rows.withColumn("key", key)
    done = None
    while True:
        large = rows.where("hi - lo > 1").groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > group_rows).select("key")
        large = written(large, "large-groups")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rest = rows.join(large, "key", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        parts = F.expr("array(struct(lo AS lo, (lo + hi) div 2 AS hi), struct((lo + hi) div 2 AS lo, hi AS hi))")
        again = rows.where("hi - lo > 1").join(large, "key", "left_semi").select("word", "n", "short", F.inline(parts))
        again = again.select("word", "n", "short", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))
        rows = again.withColumn("key", key)


def near_words(words: DataFrame, shortest: int = 7, group_rows: int = GROUP_ROWS) -> DataFrame:
    """word, n_near, best_n, best: for each word with any, how many of the others are one inserted, deleted or replaced code point
    away, and the most frequent of them (ties: the first in code-point order). words: word, n, each once, `shortest` code points or more."""
    rows = _dealt(words, shortest, group_rows)
    rows = rows.repartition("key").sortWithinPartitions("key", "short", "lo", "hi")
    find_package(words.sparkSession)
    return rows.select("key", "short", "lo", "hi", "word", "n").mapInArrow(_blocks, _FOUND)


def variant_groups(counts: DataFrame, least_length: int = 7, least_count: int = 2, factor: int = 10, group_rows: int = GROUP_ROWS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least `least_length` code points that is there `least_count` times.

    form is the most frequent near word if it is at least `factor` times as frequent (with form_n, else both null); root is the end
    of the forms from a word on, itself if it has none. counts: word, n; null words are left out, an empty table gives an empty result.
    """
    words = written(counts.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count)).select("word", "n"), "words")
    near = near_words(words, least_length, group_rows)
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    rows = rows.unionByName(near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best"))
    rows = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best").isNotNull(), best)).alias("best"))
    form = -F.col("best.less") >= factor * F.col("n")
    rows = written(rows.select("word", "n", "n_near", F.when(form, F.col("best.word")).alias("form"), F.when(form, -F.col("best.less")).alias("form_n")), "forms")

    # each form is `factor` times as frequent as what leads to it, so no way is longer than the counts allow; each round doubles the steps
    most = words.agg(F.max("n")).first()[0] or 1
    steps = int(np.floor(np.log(max(1, most / least_count)) / np.log(factor) + 1e-9))
    ways = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(int(np.ceil(np.log2(max(1, steps))))):
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = written(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "ways")
    out = rows.join(ways, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
