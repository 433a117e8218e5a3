"""Sharding by balanced label propagation, with DataFrame operations only.

Documents with equal texts are linked. A document's first shard comes from a hash of its id, which knows
no links. Each round counts a group's members by shard, moves every
member towards the shard where most of its neighbours are, and then restores the capacity quotas:
shards above their quota give up the documents that cost the fewest cut edges (unlinked ones first,
whole groups in a row after them), which fill the shards below quota in order. Row counts differ by
one at most after every round. A group larger than a shard fills several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ranked, written


def quota_table(total: int, shards: int):
    return [(s, total // shards + (s < total % shards)) for s in range(shards)]


def _by_bounds(value: Column, bounds: list[tuple[int, int]]) -> Column:
    """The label of the first (label, upper bound) whose bound is above value: a list as long as the shards."""
    out = F.lit(bounds[-1][0]) if bounds else F.lit(0)
    for label, upper in reversed(bounds[:-1]):
        out = F.when(value < upper, F.lit(label)).otherwise(out)
    return out.cast("int")


def _quota(shard: Column, quotas: dict[int, int]) -> Column:
    return F.element_at(F.array(*[F.lit(quotas[s]).cast("long") for s in sorted(quotas)]), shard + 1)


def shard_by_links(rows: DataFrame, id_column: str, group_column: str, shards: int = 16, rounds: int = 2) -> DataFrame:
    """rows with `shard` (0 to shards-1; counts at most one apart) and `slot` (gapless from 0 in a shard).

    Rows with one value of group_column are linked, null is no link. Ids may be null or repeat: rows
    are told apart by a row key that is made here; an empty table gives an empty result. The number
    of shards is small; what the driver sees is one count for each shard.
    """
    ids = F.xxhash64(F.col(id_column), F.col(group_column))
    state = rows.select(F.col(id_column).alias("id"), F.col(group_column).alias("g"), ids.alias("h"), F.monotonically_increasing_id().alias("key"))
    state = written(state.withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(shards)).cast("int")), "shards")
    total = state.count()
    quotas = dict(quota_table(total, shards))
    for _ in range(rounds):
        # towards the neighbours: members of a group by shard, then the fullest shard of each group
        here = state.where("g is not null").groupBy("g", "shard").agg(F.count("*").alias("n"))
        pull = here.groupBy("g").agg(F.sum("n").alias("size"), F.max(F.struct("n", (-F.col("shard")).alias("low"))).alias("most"))
        pull = pull.where("size > 1").select("g", "size", (-F.col("most.low")).alias("to"))
        # written, so that both sides of the join come straight from an exchange and a hot group can be split
        moved = state.join(written(pull, "pull"), "g", "left").select("id", "g", "h", "key", F.coalesce("to", "shard").cast("int").alias("shard"), F.coalesce("size", F.lit(1)).alias("size"))
        # the quotas: in each shard the documents that cost least to move come first
        cost = F.when(F.col("size") > 1, F.xxhash64("g")).otherwise(F.lit(None).cast("long"))
        linked = (F.col("size") > 1).cast("int")
        moved = moved.withColumns({"linked": linked, "cost": cost})
        counts = {(r["shard"], r["linked"]): r["n"] for r in moved.groupBy("shard", "linked").agg(F.count("*").alias("n")).collect()}
        size = {s: counts.get((s, 0), 0) + counts.get((s, 1), 0) for s in range(shards)}
        excess = {s: max(0, size[s] - quotas[s]) for s in range(shards)}
        room = [(s, quotas[s] - size[s]) for s in range(shards) if size[s] < quotas[s]]
        if not room:
            state = written(moved.select("id", "g", "h", "key", "shard"), "shards")
            break
        free = {s: min(excess[s], counts.get((s, 0), 0)) for s in range(shards)}
        rest = {s: excess[s] - free[s] for s in range(shards)}
        # ranks of unlinked rows by key, of linked rows by group, so that a group leaves in one run; a group
        # that is large for a shard is dealt by row as well
        by_group = F.col("cost").isNotNull() & (F.col("size") * 8 <= total // shards)
        spread = F.when(by_group, F.col("cost")).otherwise(F.xxhash64("key"))
        spot = ranked(moved.select("key", "shard", "linked", "cost", spread.alias("spread")), ["shard", "linked"], ["cost", "key"], F.col("spread"), "r")
        leaving = spot.where(F.col("r") < F.when(F.col("linked") == 0, _quota(F.col("shard"), free)).otherwise(_quota(F.col("shard"), rest)))
        base = {}
        at = 0
        for part in (1, 0):  # linked rows first, so that they fill a shard together
            for s in range(shards):
                base[s, part] = at
                at += free[s] if part == 0 else rest[s]
        start = F.when(F.col("linked") == 0, _quota(F.col("shard"), {s: base[s, 0] for s in range(shards)})).otherwise(_quota(F.col("shard"), {s: base[s, 1] for s in range(shards)}))
        upper, bounds = 0, []
        for s, n in room:
            upper += n
            bounds.append((s, upper))
        placed = leaving.select("key", _by_bounds(start + F.col("r"), bounds).alias("new"))
        state = written(moved.join(placed, "key", "left").select("id", "g", "h", "key", F.coalesce("new", "shard").alias("shard")), "shards")
    out = ranked(state, ["shard"], ["key"], F.xxhash64("key"), "slot")
    return out.select("id", "g", "shard", "slot")


def cut_pairs(sharded: DataFrame) -> DataFrame:
    """Linked pairs within and across shards, from counts: one row."""
    here = sharded.where("g is not null").groupBy("g", "shard").agg(F.count("*").alias("n"))
    group = here.groupBy("g").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("within"))
    return group.agg(F.coalesce(F.sum("within"), F.lit(0.0)).alias("within"), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2 - F.col("within")), F.lit(0.0)).alias("cut"))


def shard_documents(documents: DataFrame, shards: int = 16, rounds: int = 2) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null).

    Size is the text's UTF-8 bytes plus one (a null text is an empty one, and all empty texts are one
    group). doc_id may be null or repeat; each row gets its own slot. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    group = F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"), F.octet_length(text).alias("n"), F.crc32(text).alias("crc"))
    rows = documents.select(F.struct("doc_id").alias("id"), group.alias("g"))  # texts of any length are hashed whole
    out = shard_by_links(rows, "id", "g", shards, rounds)
    return out.select(
        F.col("id.doc_id").alias("doc_id"),
        (F.col("g.n").cast("long") + 1).alias("size"),
        F.col("g.crc").cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
