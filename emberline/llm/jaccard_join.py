"""Exact n-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles. Every shingle flips one bit of a sketch, so equal
sketch parts come from equal (or cancelling) parts of the sets and the Hamming distance of two
sketches is at most the size of the sets' symmetric difference. Sets of n and m elements with a
Jaccard similarity of a/b or more differ in at most D = (b-a)(n+m)/(b+a) elements. In each band of set
sizes the sketch has D+1+k segments for the largest D of the band: at least k+1 segments of two similar
sets are equal. Each set leaves out its k segments with the fewest odd bits (ties by key); of the equal
ones the last in this order is left out by neither, and there the sets meet. So sparse segments, which
many unlike sets share, are no meeting places. A set stands in the band of its size and in the next
one, so that all pairs of near enough sizes share a band.

Equal sets are one node from the start. What meets is compared by a short sketch, then by a long one,
then by the whole sets. Per segment, all sets are compared with the first, the pivot; where that leaves
sets that met one pivot in different components, all pairs of them across components are compared, in
blocks, and a block gives the links that join components, not all its pairs. So no link between
components is missed, and neither copies nor near copies are expanded into pairs.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import arrow_map, chunks, gram_hashes, mix, partitions, shielded, span_names, unshielded, word_bounds, written
from .graph import components

#: Bits of a segment's parity, so many that unlike shingles do not share one: a segment of few shingles would else be that of many
#: unlike sets; bits of the short and the long sketch for each possible difference.
SEGMENT_BITS, SHORT_BITS, LONG_BITS = 1 << 32, 3, 64
#: Sets (or so many shingles) of a pivot that meet others in one task; pairs that are compared at a time.
MEMBER_BLOCK, SHINGLE_BLOCK, PAIRS_AT_ONCE = 2048, 4_000_000, 500_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each document's n-word shingles, end to end, and the offsets.

    A-Z count as a-z. A text of fewer words has its whole sequence of words as one shingle; one
    without words has an empty set.
    """
    starts, ends, first = word_bounds(data, offsets)
    words = span_names(data, starts, ends, fold_case=True)
    grams, bounds = gram_hashes(words, first, n)
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = []
        for d in short:  # fewer than n words each
            h = np.uint64(len(words[first[d] : first[d + 1]]))
            for w in words[first[d] : first[d + 1]]:
                h = np.uint64((int(h) * 0xD6E8FEB86659FD93 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            whole.append(h)
        grams = np.concatenate([grams, mix(np.array(whole, np.uint64) ^ np.uint64(0x5851F42D4C957F2D))])
        docs = np.concatenate([docs, short])
    order = np.lexsort((grams, docs))
    grams, docs = grams[order], docs[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
    grams, docs = grams[keep], docs[keep]
    return grams, np.searchsorted(docs, np.arange(len(offsets)))


class Join:
    """The arithmetic of one similarity: percent of 100."""

    def __init__(self, percent: int, n: int):
        self.percent, self.n = percent, n

    def most_difference(self, total):
        """The largest symmetric difference of linked sets whose sizes add up to `total`."""
        return (100 - self.percent) * total // (100 + self.percent)

    def bands(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band of each size and the largest size of that band, bands widening by 100/percent."""
        tops = self.tops(int(sizes.max()) if len(sizes) else 1)
        band = np.searchsorted(tops, sizes)
        return band, tops

    def tops(self, largest: int) -> np.ndarray:
        tops = [1]
        while len(tops) < 3 or tops[-2] < largest:  # one band beyond the largest, which it stands in too
            tops.append(max(tops[-1] + 1, 100 * tops[-1] // self.percent))
        return np.array(tops, np.int64)

    def segments(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segments of the sketches of a band with the largest size `top`, and how many of them a set leaves out."""
        most = self.most_difference(2 * top) + 1
        return most + most // 2, most // 2

    def keys(self, grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the segments that every set meets others in, in its two bands, and the set of each key. The
        last bit of a key is 1 in the set's own band, 0 in the next."""
        sizes = np.diff(bounds)
        sets = np.repeat(np.arange(len(sizes)), sizes)
        band, tops = self.bands(sizes)
        out_keys, out_sets = [], []
        for up in (0, 1):
            b = band + up
            segments, left_out = self.segments(tops[b])
            segments = np.where(sizes > 0, segments, 0)
            base = np.concatenate([[0], np.cumsum(segments)])
            bits = (segments * SEGMENT_BITS).astype(np.uint64)[sets]
            place = mix(grams ^ np.uint64(0x632BE59BD9B4E019)) % bits if len(grams) else grams
            # the bits that are flipped an odd number of times: each has a random value, a segment their exclusive or
            spot = np.sort((base[:-1] * SEGMENT_BITS).astype(np.uint64)[sets] + place)
            at = np.flatnonzero(np.append(True, spot[1:] != spot[:-1])) if len(spot) else np.zeros(0, np.int64)
            spot = spot[at[np.diff(np.append(at, len(spot))) % 2 == 1]]
            segment = (spot // np.uint64(SEGMENT_BITS)).astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), segments)
            flip = mix(spot - (base[owner[segment]] * SEGMENT_BITS).astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
            parity, odd = np.zeros(base[-1], np.uint64), np.bincount(segment, minlength=base[-1])
            if len(segment):
                at = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
                parity[segment[at]] = np.bitwise_xor.reduceat(flip, at)
            rank = np.arange(base[-1]) - base[owner]
            tag = (b[owner].astype(np.uint64) << np.uint64(40)) + rank.astype(np.uint64)
            keys = mix(parity + mix(tag))
            order = np.lexsort((keys, odd, owner))[rank >= left_out[owner]]
            out_keys.append(keys[order] & ~np.uint64(1) | np.uint64(1 - up))  # the last bit: a set of the band itself
            out_sets.append(owner[order])
        return np.concatenate(out_keys), np.concatenate(out_sets)


def _nodes(grams: np.ndarray, bounds: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set; an empty set is 0."""
    out = []
    for k in (salt, salt + 1000):
        total = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(mix(grams + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)), out=total[1:])
        size = np.diff(bounds).astype(np.uint64)
        out.append(np.where(size == 0, np.uint64(0), mix(total[bounds[1:]] - total[bounds[:-1]] + size) | np.uint64(1)))
    return out[0].astype(np.int64), out[1].astype(np.int64)


def _parities(rule: Join, tops: np.ndarray, grams: np.ndarray, bounds: np.ndarray, band: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches of the sets, of `bits` a difference that is possible in `band`: 64-bit words end to end and the offsets."""
    sizes = np.diff(bounds)
    words = np.where(sizes > 0, bits * (rule.most_difference(2 * tops[band]) + 1) // 64 + 1, 0)
    base = np.concatenate([[0], np.cumsum(words)])
    sets = np.repeat(np.arange(len(sizes)), sizes)
    bit = mix(grams ^ np.uint64(0x1405789D3F84D5B5)) % (64 * words[sets]).astype(np.uint64) if len(grams) else grams
    odd = np.bincount(64 * base[sets] + bit.astype(np.int64), minlength=64 * base[-1]) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64), base


def _sketches(rule: Join, grams: np.ndarray, bounds: np.ndarray, bits: int) -> dict[str, pa.Array]:
    """The bands of the sets and their sketches, as of their own band and of the next."""
    sizes = np.diff(bounds)
    band, tops = rule.bands(sizes)
    out = {"size": pa.array(sizes), "band": pa.array(band.astype(np.int32))}
    for name, b in (("own", band), ("next", band + 1)):
        words, base = _parities(rule, tops, grams, bounds, b, bits)
        out[name] = pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), pa.array(words.view(np.int64)))
    return out


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of lists end to end, as unsigned ones, and the offsets."""
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    base = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy().view(np.uint64), base - base[0]


def _meet(batches):
    """Of blocks of (keys, nodes): pairs of each key's first node, the pivot, with its others, and whether a key had more than two.

    The pivot is of the band itself. Sets of the band below meet each other there, so a key of them alone gives none.
    """
    keys, nodes = [], []
    for batch in batches:
        keys += [np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64) + (np.uint64(b) << np.uint64(32)) for b, x in zip(batch.column("bucket").to_pylist(), batch.column("keys"), strict=True)]
        nodes += [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("nodes")]
    if not keys:
        return
    k, v = np.concatenate(keys) ^ np.uint64(1), np.concatenate(nodes)  # sets of the band itself come first
    del keys, nodes
    order = np.lexsort((v, k))
    k, v = k[order], v[order]
    del order
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
    k, v = k[new], v[new]
    below, k = (k & np.uint64(1)).astype(bool), k >> np.uint64(1)
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    del k, new
    sizes = np.diff(np.append(at, len(v)))
    rest = np.repeat((sizes > 1) & ~below[at], sizes)
    rest[at] = False
    a, b, several = np.repeat(v[at], sizes)[rest], v[rest], np.repeat(sizes > 2, sizes)[rest]
    order = np.lexsort((~several, b, a))
    a, b, several = a[order], b[order], several[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    new &= a != b
    yield pa.RecordBatch.from_arrays([pa.array(c[new]) for c in (a, b, several)], names=["a", "b", "several"])


def similarity_rows(documents: DataFrame, n: int = 3, percent: int = 90, salt: int = 0) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash and part of every row; similarity_classes() says the rest.

    `part` is one number for all rows of a component (null for an empty set), `text_hash` the xxhash64 of the text.
    """
    rule = Join(percent, n)
    rows = documents.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))

    def describe(batch: pa.RecordBatch):
        for part, data, offsets in chunks(batch, "text"):
            grams, bounds = shingle_sets(data, offsets, n)
            node, check = _nodes(grams, bounds, salt)
            yield {"doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"), "node": node, "check": check} | _sketches(rule, grams, bounds, SHORT_BITS)

    described = written(arrow_map(rows, describe, "doc_id long, text_hash long, node long, `check` long, size long, band int, own array<long>, next array<long>"), "sets")
    sets = described.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min("check").alias("low"), F.max("check").alias("high"), F.first("band").alias("band"))
    sets = written(sets, "nodes")
    if not sets.where("low <> high").isEmpty():  # two sets of one name: all again with other names
        return similarity_rows(documents, n, percent, salt + 1)

    # sets meet by segment: blocks of keys, dealt by the key
    total = described.agg(F.sum("size")).first()[0] or 0
    deal = max(partitions(documents), total // 2_000_000 + 1)
    buckets = 4 * deal

    def segments(batch: pa.RecordBatch):
        for _, data, offsets in chunks(batch, "text"):
            grams, bounds = shingle_sets(data, offsets, n)
            node, _ = _nodes(grams, bounds, salt)
            keys, owner = rule.keys(grams, bounds)
            bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
            keys, node = (keys & np.uint64(2**32 - 1)) | (bucket << np.uint64(32)), node[owner]
            order = np.lexsort((node, keys))
            keys, node = keys[order], node[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (node[1:] != node[:-1])  # copies in the chunk
            keys, node = keys[new], node[new]
            edges = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            keys = keys.astype(np.uint32)
            used = np.flatnonzero(np.diff(edges))
            yield {"bucket": used, "keys": [keys[edges[b] : edges[b + 1]].tobytes() for b in used], "nodes": [node[edges[b] : edges[b + 1]].tobytes() for b in used]}

    blocks = arrow_map(rows, segments, "bucket int, keys binary, nodes binary").repartition(deal, "bucket")
    met = blocks.mapInArrow(_meet, "a long, b long, several boolean")
    met = written(met.groupBy("a", "b").agg(F.max("several").alias("several")), "met")

    # pivots are compared with what they met
    wanted = met.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    looks = written(described.join(wanted, "node", "left_semi").dropDuplicates(["node"]).select("node", "size", "band", "own", "next"), "looks")
    star = written(_near(met.select("a", "b"), looks, rule), "pairs")
    whole = _whole(rows, sets, star.select(F.explode(F.array("a", "b")).alias("node")), rule, salt)
    links = _verified(star, whole, rule)
    parts = written(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "parts")

    # what met one pivot and is not one component yet: all pairs across components, in the pivot's band
    slim = looks.select("node", "size", "band")
    members = met.where("several").join(slim.select(F.col("node").alias("a"), F.col("band").alias("of_pivot")), "a")
    members = members.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "of_pivot").join(slim, "node").join(parts, "node", "left")
    members = members.where("of_pivot - band in (0, 1)").select("pivot", F.col("of_pivot").alias("level"), "node", F.coalesce("component", "node").alias("part"), "size", (F.col("of_pivot") == F.col("band")).alias("top"))
    sketch = F.when(F.col("top"), F.col("own")).otherwise(F.col("next"))
    near = written(_in_blocks(members, looks.select("node", "own", "next"), sketch, _near_members(rule), "pivot long, level int, node long, part long, size long, top boolean").distinct(), "near")
    whole = _whole(rows, sets, near.select("node"), rule, salt)
    more = _in_blocks(near, whole.select("node", "set"), F.col("set"), _joining_links(rule), "a long, b long")
    links = written(links.unionByName(more.distinct()), "links")
    parts = written(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "parts")

    least = parts.join(sets, "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = sets.join(parts, "node", "left").join(written(least, "least"), "component", "left")
    ids = written(ids.select("node", F.coalesce("component_id", "least_id").alias("component_id"), F.coalesce("component", "node").alias("part")), "ids")
    out = described.select("doc_id", "text_hash", "node", "size").join(ids, "node", "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "text_hash", "part")


def similarity_classes(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id: documents are linked when 100 * |A & B| >= percent * |A | B|.

    component_id is the smallest doc_id that is reached by links, the document's own included. A null
    text is an empty one: an empty set, linked with nothing. Rows with repeated ids are rows of their
    own; a null id is linked but names no component (which is null if all its ids are). Texts of any
    length are taken whole. Other columns are not read; an empty table gives an empty result.
    """
    return similarity_rows(documents, n, percent).select("doc_id", "n_shingles", "component_id")


def _near(pairs: DataFrame, looks: DataFrame, rule: Join) -> DataFrame:
    """The pairs whose sizes, and then sketches, let them be links."""
    side = lambda x, *names: looks.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in names])
    pairs = pairs.join(side("a", "size", "band"), "a").join(side("b", "size", "band", "own", "next"), "b")
    pairs = pairs.where((F.abs(F.col("band_a") - F.col("band_b")) <= 1) & (100 * F.least("size_a", "size_b") >= rule.percent * F.greatest("size_a", "size_b")))
    # one of b's sketches goes to a
    level = F.greatest("band_a", "band_b")
    pairs = pairs.select("a", "b", level.alias("level"), (F.col("size_a") + F.col("size_b")).alias("total"), F.when(level == F.col("band_b"), F.col("own_b")).otherwise(F.col("next_b")).alias("sketch"))
    met = pairs.join(side("a", "band", "own", "next"), "a")
    xor = F.zip_with("sketch", F.when(F.col("level") == F.col("band_a"), F.col("own_a")).otherwise(F.col("next_a")), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    distance = F.aggregate(xor, F.lit(0).cast("long"), lambda s, x: s + x)
    return met.where(distance * (100 + rule.percent) <= (100 - rule.percent) * F.col("total")).select("a", "b")


def _in_blocks(members: DataFrame, held: DataFrame, value: Column, function, schema: str) -> DataFrame:
    """function over the groups of (pivot, level), from a table of whole groups to a dict of columns; `value`
    is what comes to each member's row from `held`, by node.

    Only groups of several components take part. Members of other components than the group's largest
    (guests) meet all members (hosts). Hosts and guests are dealt into blocks, and a pair of blocks is a
    group of its own, of `MEMBER_BLOCK` hosts and guests at most, about.
    """
    key = ["pivot", "level"]
    counts = members.groupBy(*key, "part").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    blocks = lambda n, s: F.ceil(F.greatest(n / MEMBER_BLOCK, s / SHINGLE_BLOCK)).cast("long")
    n, s, major = F.sum("n"), F.sum("s"), F.max(F.struct("n", "s", "part"))
    groups = counts.groupBy(*key).agg(major.getField("part").alias("major"), blocks(n, s).alias("hosts"), blocks(n - major.getField("n"), s - major.getField("s")).alias("guests"), F.count("*").alias("parts"))
    groups = groups.where("parts > 1").withColumn("guests", F.greatest("guests", F.lit(1)))
    here = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n)
    rows = members.join(groups, key).withColumn("minor", F.col("part") != F.col("major"))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("hosts") * F.col("guests") - 1)))
    rows = rows.withColumns({"host": F.floor(F.col("at") / F.col("guests")) == here(F.col("hosts"), 1), "guest": F.col("minor") & (F.col("at") % F.col("guests") == here(F.col("guests"), 2))})
    rows = rows.where("host or guest").select(F.xxhash64(*key, "at").alias("group"), *members.columns, "minor", "host", "guest")
    rows = rows.join(held, "node").select(*rows.columns, value.alias("value"))
    rows = rows.repartition("group").sortWithinPartitions("group")
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        held = []
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                held.append(batch)
            if not held:
                continue
            table = pa.Table.from_batches(held)
            group = table.column("group").to_numpy()
            cut = int(np.searchsorted(group, group[-1], "left")) if batch is not None else len(group)  # the last group may go on
            if cut:
                found = function(table.slice(0, cut))
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in target], schema=target)
                held = table.slice(cut).combine_chunks().to_batches() if cut < len(group) else []

    return rows.mapInArrow(run, schema)


def _met_pairs(table: pa.Table, rule: Join):
    """Index pairs (guest, host) of each group, some at a time: of two components and near enough sizes."""
    group, node, part, size = (table.column(c).to_numpy() for c in ("group", "node", "part", "size"))
    minor, host, guest, top = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("minor", "host", "guest", "top"))
    host, guest = np.flatnonzero(host), np.flatnonzero(guest)
    low = np.searchsorted(group[host], group[guest], "left")
    count = np.searchsorted(group[host], group[guest], "right") - low
    cut = np.unique(np.append(np.searchsorted(np.cumsum(count), np.arange(0, count.sum(), PAIRS_AT_ONCE), "left"), len(count)))
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        n = count[i:j]
        x = np.repeat(guest[i:j], n)
        y = host[np.repeat(low[i:j], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        # two guests meet in both ways, and sets of the band below in a level of their own
        ok = (part[x] != part[y]) & (~minor[y] | (node[x] < node[y])) & (top[x] | top[y])
        ok &= 100 * np.minimum(size[x], size[y]) >= rule.percent * np.maximum(size[x], size[y])
        yield x[ok], y[ok]


def _apart(rule: Join, size: np.ndarray, words: np.ndarray, base: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that may be links by their sketches, and the distances of those."""
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    width = np.diff(base)[x]
    for w in np.unique(width):
        a, b = x[width == w], y[width == w]
        apart = np.zeros(len(a), np.int64)
        for k in range(w):
            apart += np.bitwise_count(words[base[a] + k] ^ words[base[b] + k])
        near = apart * (100 + rule.percent) <= (100 - rule.percent) * (size[a] + size[b])
        for o, v in zip(out, (a, b, apart), strict=True):
            o.append(v[near])
    return tuple(np.concatenate(o) for o in out)


def _near_members(rule: Join):
    """The members of groups that are near a member of another component by their short sketches."""

    def found(table: pa.Table) -> dict:
        words, base = _lists(table.column("value"))
        size = table.column("size").to_numpy()
        near = np.zeros(table.num_rows, bool)
        for x, y in _met_pairs(table, rule):
            for side in _apart(rule, size, words, base, x, y)[:2]:
                near[side] = True
        rows = table.filter(pa.array(near))
        return {c: rows.column(c).combine_chunks() for c in ("pivot", "level", "node", "part", "size", "top")}

    return found


def _joining_links(rule: Join):
    """Links between members of different components, by their whole sets; of links that join the same components, one."""

    def found(table: pa.Table) -> dict:
        grams, bounds = _lists(table.column("value"))
        node, part, level = (table.column(c).to_numpy() for c in ("node", "part", "level"))
        size = np.diff(bounds)
        words, base = _parities(rule, rule.tops(int(size.max())), grams, bounds, level, LONG_BITS)
        joined: dict[int, int] = {}

        def root(p: int) -> int:
            path = []
            while p in joined:
                path.append(p)
                p = joined[p]
            joined.update(dict.fromkeys(path, p))
            return p

        a, b = [], []
        for x, y in _met_pairs(table, rule):
            x, y, apart = _apart(rule, size, words, base, x, y)
            order = np.argsort(apart, kind="stable")
            for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
                p, q = root(int(part[i])), root(int(part[j]))
                if p == q:
                    continue
                common = len(np.intersect1d(grams[bounds[i] : bounds[i + 1]], grams[bounds[j] : bounds[j + 1]], assume_unique=True))
                if 100 * common >= rule.percent * (int(size[i]) + int(size[j]) - common):
                    joined[p] = q
                    a.append(int(node[i]))
                    b.append(int(node[j]))
        return {"a": a, "b": b}

    return found


def _whole(rows: DataFrame, sets: DataFrame, wanted: DataFrame, rule: Join, salt: int) -> DataFrame:
    """node, set, size, band and long sketches of the wanted nodes."""
    wanted = written(wanted.distinct(), "wanted")
    ids = sets.join(wanted, "node", "left_semi").select("least_id").distinct()
    n = rule.n

    def whole(batch: pa.RecordBatch):
        for _, data, offsets in chunks(batch, "text"):
            grams, bounds = shingle_sets(data, offsets, n)
            node, _ = _nodes(grams, bounds, salt)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(grams.view(np.int64)))
            yield {"node": node, "set": lists} | _sketches(rule, grams, bounds, LONG_BITS)

    some = rows.join(ids, rows["doc_id"].eqNullSafe(ids["least_id"]), "left_semi").select("text")
    held = arrow_map(some, whole, "node long, `set` array<long>, size long, band int, own array<long>, next array<long>")
    return written(held.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "whole")


def _verified(pairs: DataFrame, whole: DataFrame, rule: Join) -> DataFrame:
    """The pairs of nodes whose whole sets are similar enough, after a look at their long sketches."""
    near = written(_near(pairs, whole.drop("set"), rule), "near")
    side = lambda x: whole.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    both = near.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return written(both.where(100 * common >= rule.percent * union).select("a", "b"), "links")


def one_of_each_class(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """documents with one row of each class of similar texts: the one whose doc_id is the smallest.

    Where the smallest id repeats in a class, the text with the smallest hash stays, once. Texts
    without words and rows without an id are in no class and stay. An id that repeats in unlike
    texts stays for those that are the first of their class. The columns are those of documents, whatever their names.
    """
    columns, documents = documents.columns, shielded(documents, ["doc_id", "text"])
    classes = written(similarity_rows(documents, n, percent).where("doc_id is not null and part is not null").select("doc_id", "text_hash", "part"), "classes")
    kept = classes.groupBy("part").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    rows = classes.groupBy("part", "doc_id", "text_hash").agg(F.count("*").alias("n")).join(kept, "part").withColumn("stays", F.struct("doc_id", "text_hash") == F.col("kept"))
    rows = written(rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n", "stays").where("not stays or n > 1"), "gone")
    same = (documents["doc_id"] == F.col("_id")) & (F.xxhash64(F.coalesce(documents["text"], F.lit(""))) == F.col("_hash"))
    out = documents.join(rows.where("not stays"), same, "left_anti")
    if not rows.where("stays").isEmpty():  # equal rows of one id
        again = out.join(rows.where("stays"), same, "left_semi").dropDuplicates(["doc_id", "text"])
        out = out.join(rows.where("stays"), same, "left_anti").unionByName(again)
    return out.select(*unshielded(columns, ["doc_id", "text"]))
