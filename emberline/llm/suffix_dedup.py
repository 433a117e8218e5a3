"""Removal of long repeated byte strings, by a hash-compared suffix sort.

Every string of `length` bytes has an anchor: of its short grams the one with the smallest hash. Equal
strings have the same anchor at the same place in them, so the strings of the corpus fall apart by
anchor, and only those that share one need be sorted against each other. The strings of one anchor in
one place overlap to one context. Contexts that are equal as a whole are repeated as a whole: they are told
apart by a cryptographic digest of their bytes, as polynomial hashes can be made to collide. Where an
anchor stands in different contexts, their suffixes are sorted by mergesort. Two suffixes compare in
a logarithmic number of steps: prefix polynomial hashes and binary search find their common
extension. Neighbours in the order that share `length` bytes are compared byte by byte as well, and where
that fails all strings of the one hash are told apart by their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, mix, partitions, prefix_hashes, span_hashes, written

#: Bytes of an anchor gram; low bits of an order value that hold a position within a chunk.
GRAM, PLACE_BITS = 40, 28
#: Bytes of a text whose anchors are sought at a time; the next part begins `length` - 1 bytes before the end of the last.
WINDOW = 1 << 26
#: Bytes of input to a partition of anchors at most.
BYTES_DEALT = 1 << 25
#: Suffixes that are sorted at a time.
SORTED_AT_ONCE = 400_000


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """For each anchor of each document: doc, lo and hi (first and last start of the strings that have
    it), at (its own place), the hash of its gram and two halves of the digest of its context."""
    if len(offsets) == 2 and len(data) > WINDOW:
        parts = []
        for begin in range(0, len(data) - length + 1, WINDOW - length + 1):
            part = data[begin : begin + WINDOW]
            found = anchors(part, np.array([0, len(part)]), length)
            parts.append(found | {c: found[c] + begin for c in ("lo", "hi", "at")})
        return {c: np.concatenate([x[c] for x in parts]) for c in parts[0]}
    width = length - GRAM + 1
    empty = {c: np.zeros(0, np.int64) for c in ("doc", "lo", "hi", "at")} | {c: np.zeros(0, np.uint64) for c in ("gram", "context", "context2")}
    if len(data) < length:
        return empty
    prefix = prefix_hashes(data)
    places = np.arange(len(data) - GRAM + 1)
    gram = span_hashes(prefix, places, places + GRAM)
    least = (mix(gram ^ np.uint64(0x7F4A7C159E3779B9)) >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places.astype(np.uint64)
    done = 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    first = np.cumsum(np.maximum(np.diff(offsets) - length + 1, 0)) - np.maximum(np.diff(offsets) - length + 1, 0)
    starts = offsets[:-1][doc_of] + np.arange(len(doc_of)) - first[doc_of]
    if not len(starts):
        return empty
    at = (least[starts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    new = np.append(True, (at[1:] != at[:-1]) | (doc_of[1:] != doc_of[:-1]))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    lo, hi, at, doc = starts[begin], starts[end], at[begin], doc_of[begin]
    view, place = memoryview(np.ascontiguousarray(data)), (at - lo).astype(np.uint64)
    names = b"".join([hashlib.blake2b(view[i:j], digest_size=16).digest() for i, j in zip(lo.tolist(), (hi + length).tolist(), strict=True)])
    names = np.frombuffer(names, np.uint64).reshape(-1, 2)
    base = offsets[:-1][doc]
    return {"doc": doc, "lo": lo - base, "hi": hi - base, "at": at - base, "gram": gram[at], "context": names[:, 0] + place, "context2": names[:, 1].copy()}


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the longest common extension of the suffixes at a and b, `most` at most: binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        same = span_hashes(prefix, a, a + middle) == span_hashes(prefix, b, b + middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)


def sort_suffixes(data: np.ndarray, prefix: np.ndarray, starts: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes (their first `most` bytes) within each group, groups in ascending order.

    A bottom-up mergesort: at each level every suffix finds its place in the run beside its own by
    binary search, all at once; runs do not reach beyond a group.
    """
    order = np.argsort(group, kind="stable")
    group = group[order]
    first = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
    base = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0)) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(np.flatnonzero(first), len(group)))
    end = base + np.repeat(sizes, sizes)
    run = 1
    while len(sizes) and run < sizes.max():
        place = np.arange(len(order))
        index = (place - base) // run
        other = np.where(index % 2 == 0, base + (index + 1) * run, base + (index - 1) * run)
        low, high = np.minimum(other, end), np.minimum(other + run, end)
        beside = low.copy()
        left = index % 2 == 0  # equal suffixes of the left run go first
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) // 2
            x, y = starts[order[live]], starts[order[middle]]
            lcp = common_extension(prefix, x, y, most)
            same = lcp == most
            tail = np.minimum(lcp, most - 1)
            before = np.where(same, ~left[live], data[y + tail] < data[x + tail])  # y goes before x
            low[live] = np.where(before, middle + 1, low[live])
            high[live] = np.where(before, high[live], middle)
        own = base + index // 2 * 2 * run
        target = own + (place - base) % run + (low - beside)
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        run *= 2
    return order


def repeated_strings(contexts: list[bytes], at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """(context, first, last): runs of starts of strings of `length` bytes that another context of the
    group has at the same place before or after its anchor."""
    sizes = np.array([len(c) for c in contexts]) - length + 1
    if not len(contexts):
        return np.zeros((0, 3), np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes + length - 1)])[:-1]
    prefix = prefix_hashes(data)
    found = []
    # the strings of a group fall apart by their distance from the anchor
    todo = np.cumsum(sizes)
    cut = np.searchsorted(todo, np.arange(0, todo[-1] + SORTED_AT_ONCE, SORTED_AT_ONCE))
    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    edges = np.append(edges[np.unique(np.searchsorted(edges, cut[cut < len(contexts)], "left").clip(max=len(edges) - 1))], len(contexts))
    edges = np.unique(np.append(0, edges))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        count = sizes[lo:hi]
        most = int(at[lo:hi].max()) + 1
        slices = max(1, int(count.sum()) // SORTED_AT_ONCE)
        step = -(-most // slices)
        for near in range(0, most, step):  # distances [near, near + step) from the anchor back
            begin = np.maximum(at[lo:hi] - near - step + 1, 0)
            stop = np.minimum(at[lo:hi] - near, count - 1)
            n = np.maximum(stop - begin + 1, 0)
            owner = np.repeat(np.arange(lo, hi), n)
            start = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            distance = at[owner] - start
            key = group[owner] * np.int64(length + 1) + distance
            order = sort_suffixes(data, prefix, base[owner] + start, key, length)
            key, where, owner, start = key[order], (base[owner] + start)[order], owner[order], start[order]
            x = np.flatnonzero(key[1:] == key[:-1])
            x = x[span_hashes(prefix, where[x], where[x] + length) == span_hashes(prefix, where[x + 1], where[x + 1] + length)]
            if not len(x):
                continue
            one_hash = np.cumsum(np.append(True, np.diff(x) > 1)) - 1  # which of the runs of one hash a pair is in
            # neighbours that two contexts have in a row of places are compared byte by byte once
            a, b, s = owner[x], owner[x + 1], start[x]
            o = np.lexsort((s, b, a))
            a, b, s, t = a[o], b[o], s[o], start[x + 1][o]
            unlike: set[int] = set()
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (s[1:] != s[:-1] + 1))
            at_run = np.flatnonzero(new)
            for i, j in zip(at_run, np.append(at_run[1:], len(a)) - 1, strict=True):
                n_bytes = s[j] - s[i] + length
                if contexts[a[i]][s[i] : s[i] + n_bytes] == contexts[b[i]][t[i] : t[i] + n_bytes]:
                    found += [(a[i], s[i], s[j]), (b[i], t[i], t[j])]
                else:
                    unlike.update(one_hash[o[i : j + 1]].tolist())
            for run in unlike:  # different strings of one hash: their bytes tell which are the same
                members = np.flatnonzero(one_hash == run)
                by_bytes: dict[bytes, list[int]] = {}
                for y in range(int(x[members[0]]), int(x[members[-1]]) + 2):
                    by_bytes.setdefault(contexts[owner[y]][start[y] : start[y] + length], []).append(y)
                found += [(owner[y], start[y], start[y]) for same in by_bytes.values() if len(same) > 1 for y in same]
    return np.array(found, np.int64).reshape(-1, 3)


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) spans as maximal runs."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    return np.stack([spans[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]], axis=1)


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows with a name of their own: equal rows share one, and have equal results."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.xxhash64("doc_id", text).alias("k"), text.alias("text"))


def repeated_spans(documents: DataFrame, length: int = 200) -> DataFrame:
    """d, k, spans of each row that has a repeated string: the starts and ends (bytes) of runs of them."""
    rows = _keyed(documents).select("d", "k", "text")
    size = int(str(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # what the planner knows of the input
    deal = max(partitions(documents), size // BYTES_DEALT if size < 1 << 50 else 0)  # more than that is a guess of the planner
    buckets = 4 * deal
    names = ("d", "k", "lo", "hi", "at", "context", "context2", "gram")

    def anchor_blocks(batch: pa.RecordBatch):
        for part, data, offsets in chunks(batch, "text"):
            found = anchors(data, offsets, length)
            if not len(found["doc"]):
                continue
            own = found.pop("doc")
            columns = {"d": part.column("d").to_numpy()[own], "k": part.column("k").to_numpy()[own], **found}
            bucket = (found["gram"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(edges))
            kind = {c: np.int32 if c in ("lo", "hi", "at") else v.dtype for c, v in columns.items()}
            columns = {c: v[order].astype(kind[c]) for c, v in columns.items()}
            yield {"bucket": used} | {c: [columns[c][edges[b] : edges[b + 1]].tobytes() for b in used] for c in names}

    blocks = arrow_map(rows, anchor_blocks, "bucket int, " + ", ".join(f"{c} binary" for c in names)).repartition(deal, "bucket")

    def meet(batches):
        kinds = {"d": np.int64, "k": np.int64, "lo": np.int32, "hi": np.int32, "at": np.int32, "context": np.uint64, "context2": np.uint64, "gram": np.uint64}
        parts = {c: [] for c in names}
        for batch in batches:
            for c in names:
                parts[c] += [np.frombuffer(x.as_buffer(), kinds[c]) for x in batch.column(c)]
        v = {c: np.concatenate(parts[c]) if parts[c] else np.zeros(0, kinds[c]) for c in names}
        order = np.lexsort((v["lo"], v["k"], v["d"], v["context2"], v["context"], v["gram"]))
        v = {c: x[order] for c, x in v.items()}
        n = len(order)
        new_gram = np.append(True, v["gram"][1:] != v["gram"][:-1]) if n else np.zeros(0, bool)
        new = (new_gram | np.append(True, (v["context"][1:] != v["context"][:-1]) | (v["context2"][1:] != v["context2"][:-1]))) if n else new_gram
        size = lambda first: np.repeat(np.diff(np.append(np.flatnonzero(first), n)), np.diff(np.append(np.flatnonzero(first), n)))
        again = size(new) > 1  # the whole context is repeated
        mixed = size(new_gram) > size(new)  # its anchor stands in other contexts too
        keep = again | mixed
        compare = mixed & new  # one of each context takes part in the sort
        columns = [v["d"], v["k"], v["lo"].astype(np.int64), v["hi"].astype(np.int64), v["at"].astype(np.int64), v["gram"].view(np.int64), again, compare]
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["d", "k", "lo", "hi", "at", "gram", "again", "compare"])

    met = written(blocks.mapInArrow(meet, "d long, k long, lo long, hi long, at long, gram long, again boolean, compare boolean"), "anchors")
    whole = met.where("again").select("d", "k", "lo", (F.col("hi") + length).alias("end"))
    wanted = met.where("compare").groupBy("d", "k").agg(F.collect_list(F.struct("lo", "hi", "at", "gram", "again")).alias("wanted"))

    def contexts(batch: pa.RecordBatch):
        out = {c: [] for c in ("gram", "context", "at", "d", "k", "lo", "again")}
        for d, k, text, list_ in zip(*(batch.column(c).to_pylist() for c in ("d", "k", "text", "wanted")), strict=True):
            data = text.encode()
            for x in list_:
                for c, v in zip(out, (x["gram"], data[x["lo"] : x["hi"] + length], x["at"] - x["lo"], d, k, x["lo"], x["again"]), strict=True):
                    out[c].append(v)
        yield out

    schema = "gram long, context binary, at int, d long, k long, lo long, again boolean"
    one = rows.join(wanted, ["d", "k"]).select("d", "k", "text", "wanted")
    some = arrow_map(one, contexts, schema).repartition(deal, "gram").sortWithinPartitions("gram")

    def compare(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            gram = held.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1], "left")) if len(gram) else 0  # the last anchor may go on
            if cut:
                yield spans(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield spans(held)

    def spans(table: pa.Table) -> pa.RecordBatch:
        held = table.column("context").to_pylist()
        found = repeated_strings(held, table.column("at").to_numpy().astype(np.int64), np.unique(table.column("gram").to_numpy(), return_inverse=True)[1], length)
        again = table.column("again").to_numpy(zero_copy_only=False).astype(bool)
        found = found[~again[found[:, 0]]]
        i = found[:, 0]
        lo = table.column("lo").to_numpy()[i]
        return pa.RecordBatch.from_arrays([pa.array(table.column("d").to_numpy()[i]), pa.array(table.column("k").to_numpy()[i]), pa.array(lo + found[:, 1]), pa.array(lo + found[:, 2] + length)], names=["d", "k", "lo", "end"])

    partly = some.mapInArrow(compare, "d long, k long, lo long, end long")
    both = whole.unionByName(partly).distinct()
    return both.groupBy("d", "k").agg(F.collect_list(F.struct("lo", "end")).alias("spans"))


def remove_repeats(documents: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, kept (the bytes that remain), n_bytes, n_removed, n_spans of every row.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else. A null text is
    an empty one; shorter texts lose nothing; rows that repeat an id, or all of a row, are rows of
    their own (and repeat each other's strings). Bytes that remain need not be valid UTF-8. Other
    columns are not read; an empty table gives an empty result.
    """
    spans = written(repeated_spans(documents, length), "spans")
    rows = _keyed(documents)
    joined = rows.join(spans, ["d", "k"], "left").select("doc_id", "text", "spans")

    def cut(batch: pa.RecordBatch):
        out = {c: [] for c in ("kept", "n_bytes", "n_removed", "n_spans")}
        column = batch.column("spans")
        for text, list_ in zip(batch.column("text").to_pylist(), column.to_pylist(), strict=True):
            data = text.encode()
            runs = merged(np.array([(x["lo"], x["end"]) for x in list_ or ()], np.int64).reshape(-1, 2))
            at, parts = 0, []
            for start, end in runs.tolist():
                parts.append(data[at:start])
                at = end
            parts.append(data[at:])
            kept = b"".join(parts)
            for c, v in zip(out, (kept, len(data), len(data) - len(kept), len(runs)), strict=True):
                out[c].append(v)
        yield {"doc_id": batch.column("doc_id")} | out

    return arrow_map(joined, cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def digest(documents: DataFrame, length: int = 200) -> DataFrame:
    """remove_repeats() with the SHA-256 of what remains instead of the bytes."""
    out = remove_repeats(documents, length)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
