"""Best-fit packing of token pieces into sequences under several capacities at once.

Documents become token ids and an end token; only longer ones are cut. A sequence has capacities of
tokens, documents and attention cost (the sum of squared piece lengths); a piece goes to the sequence
which it fits under every capacity and whose weighted residual norm is then the least, longest pieces
first. What matters of a piece is its length, so the choice is made for counts by length - at most
`capacity` numbers, however large the corpus - and the k-th piece of a length looks up its place.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.scan import scanned

from .common import CHUNK_BYTES, arrow_map, chunks, ranked, span_names, word_bounds, written

#: Words whose ids each worker remembers (some 60 bytes each): beyond them those that came only once are forgotten.
REMEMBERED_WORDS = 500_000

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LETTER_OR_DIGIT = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
_LAST = np.uint64(2**64 - 1)


def _parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word_bounds with the punctuation at a word's end as a part of its own: after a letter or digit it is
    a token of its own anyway, and most of such words are known without it."""
    starts, ends, first = word_bounds(data, offsets)
    if not len(starts):
        return starts, ends, first
    body = np.where(_PUNCTUATION[data], 0, np.arange(len(data)))
    np.maximum.accumulate(body, out=body)
    body = body[ends - 1]
    cut = (body >= starts) & (body < ends - 1) & _LETTER_OR_DIGIT[data[body]]
    bars = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    cut &= np.searchsorted(bars, starts) == np.searchsorted(bars, ends - 1)  # special tokens stay whole
    n = 1 + cut
    after = np.concatenate([[0], np.cumsum(n)])
    starts, ends = np.repeat(starts, n), np.repeat(ends, n)
    tail = after[1:][cut] - 1
    starts[tail] = ends[tail - 1] = body[cut] + 1
    return starts, ends, after[first]


def _marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First and last eight bytes and length: what tells any two words of up to 16 bytes apart, and is
    held against those that have the same name."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    length = (ends - starts).astype(np.uint64)
    some = np.minimum(length, np.uint64(8))
    mask = _LAST >> (np.uint64(8) * (np.uint64(8) - some))
    return np.stack([eight[starts] & mask, eight[ends - some.astype(np.int64)] & mask, length], axis=1)


def _slices(base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions base .. base + size of all rows in turn, and the n+1 bounds of the rows among them."""
    bounds = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(base - bounds[:-1], size) + np.arange(bounds[-1]), bounds


class WordTokenizer:
    """White space parts tokens in this vocabulary's pre-tokenizer, so a text's ids are those of its words
    in turn, and words come again: their ids are kept in arrays, looked up by name."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        # one row that no word equals, so that a search always has a neighbour
        self.names, self.row = np.array([_LAST]), np.zeros(1, np.int64)  # sorted
        self.marks, self.again = np.full((1, 3), _LAST), np.ones(1, bool)
        self.base, self.size, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, "<u4")

    def _forget_rare(self) -> None:
        keep = np.flatnonzero(self.again)
        if 2 * len(keep) > REMEMBERED_WORDS:
            return self._forget()
        at, bounds = _slices(self.base[keep], self.size[keep])
        self.ids, self.base, self.size = self.ids[at], bounds[:-1], self.size[keep]
        self.marks, place = self.marks[keep], np.cumsum(self.again) - 1
        kept = self.again[self.row]
        self.names, self.row = self.names[kept], place[self.row[kept]]
        self.again = np.zeros(len(keep), bool)
        self.again[0] = True

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each word's begin and how many they are. Words of letters only are one pre-token
        each: they are encoded as one text and told apart by their ends."""
        plain = np.array([w.isalpha() or w.decode().isalpha() for w in words], bool)
        together = b" ".join([w for w, p in zip(words, plain.tolist(), strict=True) if p]).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([together], add_special_tokens=False)[0].ids, "<u4")
        sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(sizes) != plain.sum() or sizes.sum() != len(ids):
            plain[:], ids, sizes = False, ids[:0], sizes[:0]
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        alone = self.tokenizer.encode_batch_fast([words[i].decode() for i in order[len(sizes) :].tolist()], add_special_tokens=False)
        alone = [np.array(e.ids, "<u4") for e in alone]
        size = np.zeros(len(words), np.int64)
        size[order] = np.concatenate([sizes, np.array([len(x) for x in alone], np.int64)])
        base = np.zeros(len(words), np.int64)
        base[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate([ids, *alone]), base, size

    def _rows(self, data: np.ndarray, names: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of the given different words; new ones are encoded and remembered."""
        marks = _marks(data, starts, ends)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        rows = self.row[at]
        hit = (self.names[at] == names) & (self.marks[rows] == marks).all(axis=1)
        self.again[rows[hit]] = True
        fresh = np.flatnonzero(~hit)
        if len(fresh):
            whole = data.tobytes()
            ids, base, size = self._encode([whole[i:j] for i, j in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)])
            rows[fresh] = len(self.size) + np.arange(len(fresh))
            self.base, self.size = np.append(self.base, len(self.ids) + base), np.append(self.size, size)
            self.ids, self.marks = np.append(self.ids, ids), np.append(self.marks, marks[fresh], axis=0)
            self.again = np.append(self.again, np.zeros(len(fresh), bool))
            fresh = fresh[np.argsort(names[fresh])]
            both, row = np.append(self.names, names[fresh]), np.append(self.row, rows[fresh])
            order = np.argsort(both, kind="stable")
            self.names, self.row = both[order], row[order]
        return rows

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end and the n+1 offsets. Each word of the chunk is looked up once."""
        if len(self.size) > REMEMBERED_WORDS:
            self._forget_rare()
        starts, ends, first = _parts(data, offsets)
        names = span_names(data, starts, ends)
        which, different = pd.factorize(names)
        at = np.zeros(len(different), np.int64)
        at[which[::-1]] = np.arange(len(which))[::-1]  # where each first stands
        rows = self._rows(data, names[at], starts[at], ends[at])[which]
        place, after = _slices(self.base[rows], self.size[rows])
        return self.ids[place], after[first]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and end_id, cut at `capacity`; with the whole-number columns to keep."""

    end = np.array([end_id], "<u4").tobytes()

    def of(batch: pa.RecordBatch):
        for some, data, offsets in chunks(batch, "text", 2 * CHUNK_BYTES):
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            of_row = []
            ids, bounds = _tokenizer(tokenizer_path)(data, offsets)
            whole, bounds = ids.tobytes(), (4 * bounds).tolist()
            for row, (doc, begin, stop) in enumerate(zip(some.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True)):
                data = whole[begin:stop] + end
                for k, start in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[start : start + 4 * capacity]
                    for c, v in zip(out, (doc, k, start // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[c].append(v)
                    of_row.append(row)
            yield out | {c: some.column(c).take(pa.array(of_row, pa.int64())) for c in keep}

    return arrow_map(documents.select("doc_id", "text", *keep), of, "doc_id long, piece int, start long, length long, ids_crc32 long" + "".join(f", {c} long" for c in keep))


def best_fit(counts: dict[int, int], capacity: int = 2048, most_pieces: int | None = None, most_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.02, 0.02)) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Places for counts[length] pieces of each length, and the number of sequences.

    A place (length, rank, n, sequence, each, offset) says: the n pieces of that length from `rank` on
    go to the sequences from `sequence` on, `each` to one sequence, the first at `offset`. Sequences in
    the same state (what is left of each capacity) are one entry, so the work and the list depend on
    the number of different lengths only.
    """
    full = np.array([capacity, most_pieces or capacity, most_cost or capacity * capacity], np.int64)
    scale = np.sqrt(np.array(weights)) / full
    states: list[tuple[int, int, int]] = []
    left = np.zeros((0, 3), np.int64)
    ranges: list[list[tuple[int, int]]] = []
    places, sequences = [], 0

    def put(state: np.ndarray, span: tuple[int, int]) -> None:
        nonlocal left
        key = tuple(int(v) for v in state)
        if key in index:
            ranges[index[key]].append(span)
            return
        index[key] = len(states)
        states.append(key)
        ranges.append([span])
        if len(states) > len(left):
            left = np.concatenate([left, np.zeros((max(256, len(left)), 3), np.int64)])
        left[len(states) - 1] = state

    index: dict[tuple[int, int, int], int] = {}
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        todo, rank = counts[length], 0
        while todo:
            used = left[: len(states)]
            fits = np.flatnonzero((used >= need).all(axis=1)) if len(states) else np.zeros(0, np.int64)
            fits = [i for i in fits[np.argsort((((used[fits] - need) * scale) ** 2).sum(axis=1), kind="stable")] if ranges[i]]
            if fits:
                i = fits[0]
                state, (first, n) = left[i].copy(), ranges[i].pop()
            else:
                i, state = -1, full.copy()
                each = int((state // need).min())
                first, n = sequences, -(-todo // each)
                sequences += n
            each = min(todo, int((state // need).min()))
            whole = min(n, todo // each)
            places.append((length, rank, whole * each, first, each, capacity - int(state[0])))
            put(state - each * need, (first, whole))
            if whole < n and i >= 0:
                ranges[i].append((first + whole, n - whole))
            rank, todo = rank + whole * each, todo - whole * each
            if i < 0 and whole < n:  # the last new sequence takes what remains
                places.append((length, rank, todo, first + whole, todo, 0))
                put(full - todo * need, (first + whole, 1))
                rank, todo = rank + todo, 0
    return places, sequences


def pack(rows: DataFrame, capacity: int = 2048, most_pieces: int | None = None, most_cost: int | None = None, stream: tuple[str, str] | None = None) -> DataFrame:
    """rows of pieces (with `length`; written beforehand) and their sequence_id and offset.

    With stream (two whole-number columns, a part of the stream and a place in it) pieces of a length take their places in the order of
    the stream, and sequences are numbered by the first of their pieces in it.
    """
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    places, _ = best_fit(counts, capacity, most_pieces, most_cost)
    table = pd.DataFrame(places or [(0, 0, 0, 0, 1, 0)], columns=["_length", "_first", "_n", "_sequence", "_each", "_offset"]).astype("int64")
    # the places are as many as different lengths ask for, whatever the number of pieces: a bounded broadcast
    places = F.broadcast(rows.sparkSession.createDataFrame(table))
    rows_ = rows.withColumn("_key", F.monotonically_increasing_id())
    if stream:
        spots = scanned(rows_, ["length"], [*stream, "piece", "_key"], F.col(stream[0]), sums={"_rank_of_length": F.lit(1)}).withColumn("_rank_of_length", F.col("_rank_of_length") - 1).drop("_key")
    else:
        spots = ranked(rows_, ["length"], ["doc_id", "piece", "_key"], F.xxhash64("doc_id", "piece", "_key"), "_rank_of_length").drop("_key")
    r = F.col("_rank_of_length")
    inside = (F.col("length") == F.col("_length")) & (r >= F.col("_first")) & (r < F.col("_first") + F.col("_n"))
    nth = r - F.col("_first")
    out = spots.join(places, inside).select(
        *rows.columns,
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (nth % F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )
    if not stream:
        return out
    out = written(out, "packed")
    first = out.groupBy("sequence_id").agg(F.min(F.struct(*stream)).alias("at")).select("sequence_id", *[F.col(f"at.{c}").alias(c) for c in stream])
    number = scanned(first, [], [*stream, "sequence_id"], F.col(stream[0]), sums={"number": F.lit(1)}).select("sequence_id", "number")
    return out.join(number, "sequence_id").withColumn("sequence_id", F.col("number") - 1).select(*rows.columns, "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(documents: DataFrame, tokenizer_path: str | None = None, capacity: int = 2048, most_pieces: int | None = None, most_cost: int | None = None, stream: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    A null or empty text is one piece of the end token. Ids may be null or repeat: each row is a
    document of its own. Other columns are not read; an empty table gives an empty result. By default
    only the tokens bind; fewer pieces or less attention cost a sequence can be asked for. stream: see pack().
    """
    rows = written(pieces(documents, tokenizer_path or default_tokenizer(), capacity, keep=stream or ()), "pieces")
    return pack(rows, capacity, most_pieces, most_cost, stream).drop(*(stream or ()))
