"""What the operators share: scratch tables, whole-text byte buffers, word hashes and distributed ranks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from emberline.session import find_package
from emberline.sources.scratch import written  # noqa: F401  the operators take it from here

#: Bytes of text that one vectorised pass takes at a time; a longer document is a pass of its own.
CHUNK_BYTES = 1 << 20


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_OTHERS = "_others"


def shielded(documents: DataFrame, names: list[str]) -> DataFrame:
    """documents with the named columns as they are and all others in one struct, so that no name of theirs meets one made here."""
    others = [c for c in documents.columns if c not in names]
    return documents.select(*[F.col(f"`{c}`") for c in documents.columns if c in names], *([F.struct(*[F.col(f"`{c}`") for c in others]).alias(_OTHERS)] if others else []))


def unshielded(columns: list[str], names: list[str]) -> list[Column]:
    """The columns of the documents again, of a frame that came from shielded()."""
    return [F.col(f"`{c}`") if c in names else F.col(f"{_OTHERS}.`{c}`").alias(c) for c in columns]


# --- whole texts as bytes ---------------------------------------------------------------------------


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and the n+1 offsets; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most `limit` bytes of text (or one document), their bytes and offsets."""
    if not batch.num_rows:
        return
    data, offsets = text_buffer(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ and, for each document, the index of its first word (n+1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    begin = inside & ~before
    finish = np.zeros(len(data) + 1, bool)
    finish[:-1] = ~inside & before
    finish[-1] = inside[-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = cut[inside[cut] & inside[cut - 1]]
    begin[cut] = True
    finish[cut] = True
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish), np.searchsorted(starts, offsets)


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_power = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i up to n."""
    have = _power.get("n", 0)
    if n >= have:
        size = max(n + 1, CHUNK_BYTES + 1)
        inverse = pow(_MULTIPLIER, -1, 2**64)
        with np.errstate(over="ignore"):
            for name, base in (("up", _MULTIPLIER), ("down", inverse)):
                out = np.ones(size, np.uint64)
                out[1:] = base
                np.multiply.accumulate(out, out=out)
                _power[name] = out
        _power["n"] = size
    return _power["up"], _power["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hashes(data: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Prefix polynomial hashes modulo 2^64: n+1 values."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold_case else _BYTE)[data] * up[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] from prefix_hashes: equal strings have equal hashes wherever they stand."""
    _, down = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Bytes up to which spans are hashed all at once, eight bytes a step; longer ones are hashed one by one.
LONG_SPAN = 64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)


def span_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """64-bit names of data[start:end]: equal strings have equal names wherever they stand. Every eight bytes
    go through a bijection, so unlike strings of up to eight bytes of one length never share a name, and no
    family of strings is known that does, as there is for polynomials modulo a power of two."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _FOLD[data] if fold_case else data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    length = ends - starts
    out = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live = np.flatnonzero((length > 0) & (length <= LONG_SPAN))
    at = starts[live]
    left = length[live]
    while len(live):
        value = eight[at]
        value &= np.uint64(2**64 - 1) >> (np.uint64(8) * (np.uint64(8) - np.minimum(left, 8).astype(np.uint64)))
        out[live] = mix(out[live] ^ value)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    long = np.flatnonzero(length > LONG_SPAN)
    if len(long):
        view = memoryview(padded)
        out[long] = np.array([xxhash.xxh3_64_intdigest(view[a:b], 20240601) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)], np.uint64)
    return out


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive words within a document and each document's first gram (n+1 values)."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(first[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[at + k] if len(at) else out
    return mix(out), bounds


def give_back() -> None:
    """Memory that a task no longer needs goes back to the machine: workers live on, and what they keep adds up over stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with a function from one record batch to an iterable of dicts of columns."""
    fields = T._parse_datatype_string(schema)
    target = to_arrow_schema(fields)

    def run(batches):
        for batch in batches:
            for columns in function(batch):
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in target], schema=target)
        give_back()

    find_package(df.sparkSession)
    return df.mapInArrow(run, fields)


# --- ranks and running sums of large groups -----------------------------------------------------------


def ranked(df: DataFrame, keys: list[str], order: list[Column], spread: Column, rank: str, weight: Column | None = None, running: str | None = None) -> DataFrame:
    """Adds to each row its gapless rank from 0 within `keys` and, if `weight` is given, the weight before it.

    A group of any size is dealt over buckets of `spread` (a bigint hash): the rows are counted by
    (keys, bucket), the counts are summed to offsets and only a bucket is ordered in one task. Rows
    stand in the order of (bucket, order), so `order` must end in a unique column.
    """
    n = max(16, 2 * partitions(df))
    bucket = F.pmod(spread, F.lit(n)).cast("int")
    weight = F.lit(0).cast("long") if weight is None else weight
    rows = df.withColumns({"_bucket": bucket, "_weight": weight})
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"), F.sum("_weight").alias("_w"))
    # at most n rows a key: however large a group is, its offsets are one small window
    above = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(*keys, "_bucket", (F.sum("_n").over(above) - F.col("_n")).alias("_n0"), (F.sum("_w").over(above) - F.col("_w")).alias("_w0"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = rows.withColumn("_rank", F.row_number().over(inside))
    if running:
        rows = rows.withColumn("_before", F.sum("_weight").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_weight"))
    same = rows["_bucket"] == offsets["_bucket"]
    for k in keys:
        same = same & rows[k].eqNullSafe(offsets[k])
    out = {rank: F.col("_n0") + F.col("_rank") - 1}
    if running:
        out[running] = F.col("_w0") + F.col("_before")
    names = [c for c in df.columns if c not in out]
    return rows.join(offsets, same).select(*[rows[c] for c in names], *[v.alias(k) for k, v in out.items()])
