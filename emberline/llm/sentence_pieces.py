"""SentencePiece encoding and decoding of documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import CHUNK_BYTES, arrow_map, chunks
from .packing import _slices
from .piece_bpe import SPACE, PieceEncoder, encoder

#: Bytes of text in one pass over words; a longer text is taken in parts that begin at a word.
PART_BYTES = 2 * CHUNK_BYTES


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def spaced(batch: pa.RecordBatch, column: str = "text") -> pa.RecordBatch:
    """The batch's first column and its texts as the model reads them: a space before each that is not empty, marks as spaces."""
    text = pc.replace_substring(pc.fill_null(batch.column(column), "").cast(pa.large_string()), SPACE, " ")
    text = pc.if_else(pc.equal(pc.binary_length(text), 0), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
    return pa.RecordBatch.from_arrays([batch.column(0), text], names=[batch.schema.names[0], "text"])


def ids_of(encode: PieceEncoder, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """encode() for texts of any length."""
    if len(data) <= 2 * PART_BYTES or len(offsets) > 2:
        return encode(data, offsets)
    out, at = [], 0
    while at < len(data):
        words = at + PART_BYTES + np.flatnonzero((data[at + PART_BYTES :][1:] == 32) & (data[at + PART_BYTES :][:-1] != 32))[:1] + 1
        to = int(words[0]) if len(words) else len(data)
        out.append(encode(data[at:to], np.array([0, to - at]))[0])
        at = to
    ids = np.concatenate(out)
    return ids, np.array([0, len(ids)])


class Strings:
    """Short strings of numbered things, put end to end by number."""

    def __init__(self, values: list[bytes]):
        self.size = np.array([len(v) for v in values], np.int64)
        self.base, self.data = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(values), np.uint8)

    def joined(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all, and the n+1 bounds."""
        place, bounds = _slices(self.base[which], self.size[which])
        return self.data[place], bounds


@lru_cache(maxsize=2)
def _numbers(n: int) -> Strings:
    return Strings([b"%d," % i for i in range(n)])


@lru_cache(maxsize=2)
def _texts(path: str) -> Strings:
    return Strings(encoder(path).model.bytes_of)


def _blocks(n: int, size: int = 1 << 20) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, min(n, at + size))


def decoded_bytes(path: str, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The texts of all documents' ids, in UTF-8."""
    model = encoder(path).model
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = ids[a:b]
        text = b"".join(_texts(path).joined(own[k])[0].tobytes() for k in _blocks(b - a))
        plain = b > a and text[:1] == b" " and not model.is_byte[own[0]] and own[0] != model.unknown
        try:
            if plain and model.is_byte[own].any():
                text.decode()  # bytes that are no characters are replaced one by one
        except UnicodeDecodeError:
            plain = False
        out.append(text[1:] if plain else model.decode(own.tolist()).encode())
    return out


def encoded(documents: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and ids array<int> of every document, without begin or end ids. A null or empty text has none; ids of documents
    may be null or repeat, other columns are not read, and an empty table gives an empty result."""
    path = model_path or default_model()

    def of(batch: pa.RecordBatch):
        for some, data, offsets in chunks(spaced(batch), "text", PART_BYTES):
            ids, bounds = ids_of(encoder(path), data, offsets)
            yield {"doc_id": some.column(0), "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))}

    return arrow_map(documents.select("doc_id", "text"), of, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and text of rows with ids; null ids are none, null within them is skipped. Bytes that are no UTF-8 come out as U+FFFD, each one."""
    path = model_path or default_model()

    def of(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            lists = [[i for i in x or [] if i is not None] for x in some.column(1).to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            texts = decoded_bytes(path, np.array([i for x in lists for i in x], np.int64), bounds)
            yield {"doc_id": some.column(0), "text": [t.decode() for t in texts]}

    return arrow_map(rows.select("doc_id", "ids"), of, "doc_id long, text string")


def digest(documents: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 (of what the ids decode to, in UTF-8)
    of every document; null and empty texts, ids of documents and other columns as in encoded()."""
    path = model_path or default_model()

    def of(batch: pa.RecordBatch):
        for some, data, offsets in chunks(spaced(batch), "text", PART_BYTES):
            ids, bounds = ids_of(encoder(path), data, offsets)
            names = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                sha, held = hashlib.sha256(), b""
                for k in _blocks(b - a):
                    sha.update(held)
                    held = _numbers(encoder(path).model.size).joined(ids[a:b][k])[0].tobytes()
                sha.update(held[:-1])
                names.append(sha.hexdigest())
            yield {
                "doc_id": some.column(0),
                "n_tokens": np.diff(bounds),
                "ids_sha256": names,
                "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in decoded_bytes(path, ids, bounds)],
            }

    return arrow_map(documents.select("doc_id", "text"), of, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
