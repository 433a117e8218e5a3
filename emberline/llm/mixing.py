"""Mixing sources to target weights by Pfair scheduling.

The stream of a mix is a row of slots, a block of text each. With target weight w, the k-th block of a
source is released at slot floor((k-1)/w) and due at ceil(k/w); of the released blocks the one with
the earliest deadline takes the slot. As the weights add up to one, every deadline is met, and after
any number of slots each source is less than one block from its target.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, shielded, unshielded

#: Blocks of a stream, about: a larger corpus has larger blocks, so that its schedule stays a small table.
STREAM_BLOCKS = 1 << 18


def slot_counts(weights: dict, slots: int) -> dict:
    """Whole slots of a period for each weight, by largest remainders, one at least."""
    total = sum(weights.values())
    share = {s: w / total * slots for s, w in weights.items()}
    out = {s: max(1, int(v)) for s, v in share.items()}
    for s in sorted(share, key=lambda s: (int(share[s]) - share[s], str(s)))[: max(0, slots - sum(out.values()))]:
        out[s] += 1
    while sum(out.values()) > slots:  # the ones that were lifted to 1 are taken from the largest
        out[max(out, key=lambda s: (out[s], str(s)))] -= 1
    return out


def pfair(counts: dict) -> list:
    """The source of each slot of a period of sum(counts) slots: earliest deadline first among the released."""
    period = sum(counts.values())
    release = lambda s, k: (k - 1) * period // counts[s]
    deadline = lambda s, k: -(-k * period // counts[s])
    waiting = [(0, str(s), i, s, 1) for i, s in enumerate(counts)]
    heapq.heapify(waiting)
    ready, out = [], []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, name, i, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(s, k), name, i, s, k))
        _, name, i, s, k = heapq.heappop(ready)
        out.append(s)
        if k < counts[s]:
            heapq.heappush(waiting, (release(s, k + 1), name, i, s, k + 1))
    return out


def stream(weights: dict, blocks: dict) -> dict:
    """The slots of each source's blocks, by exact weights, until every source is used up.

    Time runs by 1/(sum of weights) a slot, so that block k of a source is released at (k-1)/w and due at
    k/w whatever sources are left; one that is used up leaves its share to the others by their weights.
    """
    names = list(weights)
    total = sum(weights.values())
    w = [weights[s] / total for s in names]
    ends = sorted((blocks[s] / w[i], i) for i, s in enumerate(names))
    out: dict = {s: [] for s in names}
    waiting = [(0.0, i) for i in range(len(names))]
    ready: list = []
    lives = [0.0] * len(ends)  # the weights of the sources that are left when the first few are used up
    for g in range(len(ends) - 1, -1, -1):
        lives[g] = w[ends[g][1]] + (lives[g + 1] if g + 1 < len(ends) else 0.0)
    now, gone = 0.0, 0
    for slot in range(sum(blocks[s] for s in names)):
        # the time of the slot's end: sources that are used up on the way make the rest of it faster
        left = 1.0
        while gone < len(ends) - 1 and ends[gone][0] <= now + left / lives[gone]:
            left -= max(0.0, ends[gone][0] - now) * lives[gone]
            now = max(now, ends[gone][0])
            gone += 1
        now += left / lives[gone]
        while waiting and (waiting[0][0] < now * (1 - 1e-12) or not ready):
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, ((len(out[names[i]]) + 1) / w[i], i))
        _, i = heapq.heappop(ready)
        mine = out[names[i]]
        mine.append(slot)
        if len(mine) < blocks[names[i]]:
            heapq.heappush(waiting, (len(mine) / w[i], i))
    return out


def _streamed(documents: DataFrame, rows, sizes: dict, weights: dict, block_bytes: int | None) -> DataFrame:
    """schedule() of the whole corpus: no block is left out."""
    total = sum(sizes.values())
    block_bytes = block_bytes or max(1, min(1 << 16, total // 4000), total // STREAM_BLOCKS)
    # a document without text may begin where its source's last block ends
    places = stream(weights, {s: sizes[s] // block_bytes + 1 for s in weights})
    table = pa.table({"_source": pa.array(list(places), pa.string()), "_slots": pa.array(list(places.values()), pa.list_(pa.int64()))})
    plan = documents.sparkSession.createDataFrame(table)
    rows = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_source")), "left")
    slot = F.get("_slots", F.floor(F.col("_bytes_before") / block_bytes).cast("int"))
    return rows.select(*documents.columns, slot.alias("_slot"), F.col("_slots").isNotNull(), F.col("_rank_in_source")).toDF(*documents.columns, "_slot", "_scheduled", "_rank_in_source")


#: Columns that the mix looks at.
_USED = ["doc_id", "text", "source"]


def schedule(documents: DataFrame, weights: dict | None = None, temper: float = 0.8, slots: int | None = None, block_bytes: int | None = None) -> DataFrame:
    """documents with `_slot`, the place of each row's block in the mix, and `_scheduled`.

    A source's documents follow each other by a hash of their id and text and are cut into blocks of
    `block_bytes` of text (64 KiB; less if the corpus has not 4000 such blocks, more beyond `STREAM_BLOCKS`);
    a document belongs to the block in which it begins. Without weights a source weighs its bytes to the
    power `temper`. The stream runs until every source is used up: as long as none is, each source is less
    than one block from its target at any slot, and after that the others share by their weights.

    With `slots` given, the stream is one period of so many slots, repeated, and ends with the corpus's
    number of blocks: blocks of a source beyond its target share are not scheduled, and a source with
    fewer blocks leaves its later slots empty.

    A null source is a source; null texts have no bytes; equal rows follow each other in any order;
    sources missing in the weights are not scheduled. Other columns come through; those that are called
    as the new ones are replaced.
    """
    new = ["_slot", "_scheduled", "_rank_in_source"]
    columns = [c for c in documents.columns if c not in new]
    rows = _scheduled(shielded(documents.select(*[F.col(f"`{c}`") for c in columns]), _USED), weights, temper, slots, block_bytes)
    return rows.select(*unshielded(columns, _USED), *new)


def _scheduled(documents: DataFrame, weights: dict | None, temper: float, slots: int | None, block_bytes: int | None) -> DataFrame:
    spark = documents.sparkSession
    size = F.octet_length(F.coalesce("text", F.lit("")))
    sizes = documents.groupBy("source").agg(F.sum(size).alias("bytes")).collect()
    found = {r["source"]: r["bytes"] + 1 for r in sizes}
    weights = {s: weights[s] for s in found if s in weights} if weights is not None else {s: n**temper for s, n in found.items()}
    weights = {s: w for s, w in weights.items() if w > 0}
    rows = ranked(documents.withColumns({"_key": F.xxhash64("doc_id", "text"), "_tie": F.monotonically_increasing_id()}), ["source"], ["_key", "_tie"], F.col("_key"), "_rank_in_source", weight=size.cast("long"), running="_bytes_before")
    if slots is None:
        return _streamed(documents, rows, {s: n - 1 for s, n in found.items()}, weights, block_bytes)
    counts = slot_counts(weights, max(slots, 2 * len(weights))) if weights else {}
    period = max(1, sum(counts.values()))
    total = sum(found.values())
    block_bytes = block_bytes or max(1, min(1 << 16, total // (4 * period)))
    length = -(-total // block_bytes)
    nth, table = dict.fromkeys(counts, 0), []
    for slot, s in enumerate(pfair(counts)):
        table.append((s, counts[s], nth[s], slot))
        nth[s] += 1
    # a period of slots: a few thousand rows, whatever the corpus
    plan = spark.createDataFrame(table or [(None, 1, -1, 0)], "_source string, _each long, _nth long, _at long")
    block = F.floor(F.col("_bytes_before") / block_bytes)
    each = F.broadcast(plan.select("_source", "_each").distinct())
    rows = rows.withColumn("_block", block).join(each, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rows = rows.withColumns({"_turn": F.floor(F.col("_block") / F.col("_each")), "_of_turn": F.col("_block") % F.col("_each")}).drop("_each")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_of_turn") == F.col("_nth"))
    rows = rows.join(F.broadcast(plan.select("_source", "_nth", "_at")), same, "left")
    slot = F.col("_turn") * period + F.col("_at")
    return rows.select(*documents.columns, slot.alias("_slot"), F.coalesce(slot < length, F.lit(False)).alias("_scheduled"), F.col("_rank_in_source"))


def mixed(documents: DataFrame, weights: dict | None = None, temper: float = 0.8, slots: int | None = None, block_bytes: int | None = None) -> DataFrame:
    """The scheduled documents in the order of the mix: partitions follow each other by slot."""
    rows = _scheduled(shielded(documents, _USED), weights, temper, slots, block_bytes).where("_scheduled")
    ordered = rows.repartitionByRange("_slot", F.xxhash64("doc_id", "text")).sortWithinPartitions("_slot", "source", "_rank_in_source")
    return ordered.select(*unshielded(documents.columns, _USED))
