"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Cumulative token ends of both encodings are merged; where both end, a group closes and its last tokens are
linked. Of two tokens that end together one is a suffix of the other, so the id pairs that can be linked are
the suffixes of all vocabulary entries: half a million here, whatever the corpus. Their counts are one
groupBy with sums made before the shuffle, and the table of counts is a broadcast of that proven size.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, text_buffer, written
from .piece_bpe import SPACE, encoder
from .sentence_pieces import PART_BYTES, Strings, default_model, ids_of, spaced

#: A pair is first id * PAIR + second id.
PAIR = 1 << 20
#: White space longer than this is left to the slower library, as the faster one's regular expressions overflow there.
LONG_SPACE = re.compile(r"\s{20000}")


def default_byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteEncoder:
    """Ids of a byte-level vocabulary by tiktoken, whose ranks are the file's ids; special tokens are plain text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        of = _byte_of_character()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        special = set(self.tokenizer.get_added_tokens_decoder())
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if i not in special:
                self.bytes_of[i] = bytes(of[c] for c in token)
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(self.bytes_of) if b}, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if len(text) > 20000 and LONG_SPACE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@lru_cache(maxsize=2)
def _tables(a_path: str, b_path: str) -> tuple[Strings, Strings, Strings]:
    a, b = byte_encoder(a_path).bytes_of, encoder(b_path).model.bytes_of
    return Strings(a), Strings(b), Strings([b"%d," % i for i in range(max(len(a), len(b)))])


def linkable_pairs(a_path: str, b_path: str) -> int:
    """How many id pairs can be linked at all: the bound of the table of counts."""
    a, b = byte_encoder(a_path).bytes_of, encoder(b_path).model.bytes_of
    of_b: dict[bytes, int] = {}
    for x in b:
        of_b[x] = of_b.get(x, 0) + 1
    known = set(a)
    return sum(of_b.get(x[k:], 0) for x in a for k in range(len(x))) + sum(x[k:] in known for x in b for k in range(1, len(x)))


def _aligned(a_path: str, b_path: str, data: np.ndarray, offsets: np.ndarray, marked: np.ndarray, a: np.ndarray, a_first: np.ndarray) -> dict:
    """Links of a chunk. data: spaced texts end to end; marked: texts whose bytes the second vocabulary does not give back; a: ids of the first."""
    A, B, numbers = _tables(a_path, b_path)
    n = len(offsets) - 1
    b, b_first = ids_of(encoder(b_path), data, offsets)
    b = b.astype(np.int64)
    fits = ~marked & (np.diff(offsets) > 0)
    for table, ids, first in ((A, a, a_first), (B, b, b_first)):
        text, bounds = table.joined(ids)
        same = np.diff(bounds[first]) == np.diff(offsets)
        fits &= same
        if len(text) == len(data) and same.all():
            wrong = np.flatnonzero(text != data)
            fits[np.searchsorted(offsets, wrong, "right") - 1] = False
        else:
            for k in np.flatnonzero(fits).tolist():
                fits[k] = np.array_equal(text[bounds[first[k]] : bounds[first[k + 1]]], data[offsets[k] : offsets[k + 1]])
    n_a, n_b = np.diff(a_first), np.diff(b_first)
    a, b = a[np.repeat(fits, n_a)], b[np.repeat(fits, n_b)]
    n_a, n_b = np.where(fits, n_a, 0), np.where(fits, n_b, 0)
    a_end, b_end = np.cumsum(A.size[a]), np.cumsum(B.size[b])
    size = int(a_end[-1]) if len(a) else 0
    at_a, shared = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    at_a[a_end] = True
    shared[b_end] = at_a[b_end]
    before = np.cumsum(shared)  # groups closed up to a byte
    a_last, b_last = shared[a_end], shared[b_end]
    group_a, group_b = before[a_end] - a_last, before[b_end] - b_last
    # tokens in the order of the text a1,a2|b1;a3|b2,b3
    place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
    place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
    items, sign = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    items[place_a], items[place_b] = a, b
    sign[place_a[a_last]], sign[place_b[b_last]] = ord("|"), ord(";")
    text, bounds = numbers.joined(items)
    text[bounds[1:] - 1] = sign
    doc_first = np.concatenate([[0], np.cumsum(n_a + n_b)])
    links = a[a_last] * PAIR + b[b_last]
    doc = np.repeat(np.arange(n), n_b)[b_last]
    return {"fits": fits, "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=n), "text": text, "bounds": bounds[doc_first], "links": links, "doc": doc}


def _distinct(doc: np.ndarray, links: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of each document, how often each is there, and the n+1 bounds of the documents."""
    order = np.argsort(links, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    doc, links = doc[order], links[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (links[1:] != links[:-1])
    at = np.flatnonzero(new)
    return links[at], np.diff(np.append(at, len(doc))), np.searchsorted(doc[at], np.arange(n + 1))


def aligned(documents: DataFrame, a_path: str | None = None, b_path: str | None = None, keep_groups: bool = False) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, its different linked pairs with their counts
    (pairs, times) and, if asked for, the text of its groups. Texts that are null, empty or not given back by both
    vocabularies have no tokens: zeros and ''. Ids of documents may be null or repeat; other columns are not read."""
    a_path, b_path = a_path or default_byte_bpe(), b_path or default_model()

    def of(batch: pa.RecordBatch):
        plain = spaced(batch)
        marked = pc.match_substring(pc.fill_null(batch.column("text"), ""), SPACE)
        batch = plain.append_column("marked", marked)
        for some, data, offsets in chunks(batch, "text", PART_BYTES):
            marked = some.column("marked").to_numpy(zero_copy_only=False)
            a = [byte_encoder(a_path)(t) if t and not m else np.zeros(0, np.int64) for t, m in zip(some.column("text").to_pylist(), marked.tolist(), strict=True)]
            a_first = np.concatenate([[0], np.cumsum([len(x) for x in a])]).astype(np.int64)
            out = _aligned(a_path, b_path, data, offsets, marked, np.concatenate(a), a_first)
            groups = [out["text"][i : max(i, j - 1)].tobytes() for i, j in zip(out["bounds"][:-1].tolist(), out["bounds"][1:].tolist(), strict=True)]
            pairs, times, first = _distinct(out["doc"], out["links"], some.num_rows)
            first = pa.array(first, pa.int32())
            yield {
                "doc_id": some.column(0), "n_a": out["n_a"], "n_b": out["n_b"], "n_groups": out["n_groups"], "n_links": out["n_groups"],
                "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
                "pairs": pa.ListArray.from_arrays(first, pa.array(pairs)), "times": pa.ListArray.from_arrays(first, pa.array(times.astype(np.int32))),
                "groups": [g.decode() for g in groups] if keep_groups else pa.nulls(some.num_rows, pa.string()),
            }

    rows = arrow_map(documents.select("doc_id", "text"), of, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>, groups string")
    return rows if keep_groups else rows.drop("groups")


def pair_counts(rows: DataFrame) -> DataFrame:
    """a_id, b_id, n (links of the pair in the corpus), a_best, b_best (does no pair of that id have more), from aligned() rows."""
    each = rows.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "pair-counts")
    counts = counts.select("pair", F.expr(f"pair div {PAIR}").alias("a_id"), F.expr(f"pair % {PAIR}").alias("b_id"), "n")
    for side in ("a", "b"):
        most = counts.groupBy(f"{side}_id").agg(F.max("n").alias(f"{side}_most"))
        counts = counts.join(F.broadcast(most), f"{side}_id")  # one row an id of the vocabulary
    return counts.select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("a_most")).alias("a_best"), (F.col("n") == F.col("b_most")).alias("b_best"))


def alignment(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document (see aligned()): n_best of its links
    have the highest count of their second id, ties included; count_sum adds up the counts of its links. An empty table gives an empty result."""
    rows = written(aligned(documents, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "links")
    counts = F.broadcast(pair_counts(rows).select("pair", "n", "b_best"))  # no more rows than linkable_pairs() of the two vocabularies
    each = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).join(counts, F.col("pairs") == F.col("pair"))
    sums = each.groupBy("row").agg(F.sum(F.when(F.col("b_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.drop("pairs", "times").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
