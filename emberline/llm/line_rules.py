"""Quality rules with a line sequence labeller.

Exact base counts of every text, and a linear-chain conditional random field that marks each line as
content (1) or boilerplate (0) by Viterbi decoding; the share of words on content lines decides
whether a document that passes the base rules stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks
from .quality_ranker import labelled
from .textstats import N_LINE_FEATURES, document_stats

#: The CRF is fitted on all lines of at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 1500
#: A line of the sample that stands after so many unlike lines, and before so many, is boilerplate anywhere.
RECURRING = 3


def _by_position(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences longest first: their first lines, their lengths and how many reach each position."""
    lengths = np.bincount(owner) if len(owner) else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    longest = lengths[order[0]] if len(order) else 0
    alive = np.searchsorted(-lengths[order], -np.arange(longest), "left")
    return first[order], lengths[order], alive


class LineField:
    """A linear-chain CRF of two labels: emissions x @ weights and a 2x2 table of transitions."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions

    def decode(self, x: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The likeliest labels (Viterbi) of all lines; `owner` numbers the sequences in order."""
        emit = x @ self.weights
        first, lengths, alive = _by_position(owner)
        out = np.zeros(len(x), np.int8)
        if not len(first):
            return out
        back = np.zeros((len(x), 2), np.int8)
        score = emit[first]
        for t in range(1, len(alive)):
            at = first[: alive[t]] + t
            both = score[: alive[t], :, None] + self.transitions
            back[at] = both.argmax(axis=1)
            score[: alive[t]] = both.max(axis=1) + emit[at]
        label = score.argmax(axis=1)
        end = first + lengths - 1
        out[end] = label
        for t in range(len(alive) - 1, 0, -1):
            at = first[: alive[t]] + t
            out[at - 1] = back[at, out[at]]
        return out

    def marginals(self, x: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected labels of lines and expected transitions, by forward-backward."""
        emit = x @ self.weights
        first, lengths, alive = _by_position(owner)
        a, b = emit.copy(), np.zeros_like(emit)
        for t in range(1, len(alive)):
            at = first[: alive[t]] + t
            a[at] += np.logaddexp.reduce(a[at - 1][:, :, None] + self.transitions, axis=1)
        for t in range(len(alive) - 1, 0, -1):
            at = first[: alive[t]] + t
            b[at - 1] = np.logaddexp.reduce(self.transitions + (emit[at] + b[at])[:, None, :], axis=2)
        total = np.logaddexp.reduce(a + b, axis=1, keepdims=True)
        nodes = np.exp(a + b - total)
        inner = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        pairs = np.exp(a[inner - 1][:, :, None] + self.transitions + (emit[inner] + b[inner])[:, None, :] - total[inner][:, :, None])
        return nodes, pairs.sum(axis=0)


def fit_field(x: np.ndarray, owner: np.ndarray, y: np.ndarray, rounds: int = 120, ridge: float = 1e-3) -> LineField:
    """Maximum likelihood by Adam on the exact gradient; content starts out likelier, as before any label."""
    field = LineField(np.zeros((x.shape[1], 2)), np.array([[0.5, 0.0], [0.0, 0.5]]))
    field.weights[0] = [0.0, 1.0]
    if not len(x) or y.min() == y.max():
        return field
    _, owner = np.unique(owner, return_inverse=True)
    gold = np.eye(2)[y]
    inner = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    gold_pairs = np.zeros((2, 2))
    np.add.at(gold_pairs, (y[inner - 1], y[inner]), 1)
    params = [field.weights, field.transitions]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        nodes, pairs = field.marginals(x, owner)
        grads = [x.T @ (nodes - gold) / len(x) + ridge * field.weights, (pairs - gold_pairs) / len(x) + ridge * field.transitions]
        for p, g, mm, vv in zip(params, grads, m, v, strict=True):
            mm += 0.1 * (g - mm)
            vv += 0.01 * (g * g - vv)
            p -= 0.1 * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8)
    return field


def line_labels(doc: np.ndarray, good: np.ndarray, name: np.ndarray, dup: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Labels of lines (1 content, 0 boilerplate) from those of their documents (`good`) and from each other.

    A line is labelled as its document is, but for three kinds of lines: one that repeats an earlier line
    of its document, and one that recurs in unlike surroundings (copies of a document recur in the same
    ones), are boilerplate in good documents too; one that stands in a good document as content is
    content in others. Lines without words go with the line before them.
    """
    y = good.astype(np.int64)
    if not len(y):
        return y
    inner = doc[1:] == doc[:-1]
    before, after = np.zeros(len(name), np.uint64), np.zeros(len(name), np.uint64)
    before[1:][inner], after[:-1][inner] = name[:-1][inner], name[1:][inner]
    _, which = np.unique(name, return_inverse=True)
    beside = lambda side: np.bincount(np.unique(np.stack([which.astype(np.uint64), side], axis=1), axis=0)[:, 0].astype(np.int64), minlength=which.max() + 1)
    recurs = ((beside(before) >= RECURRING) & (beside(after) >= RECURRING))[which] & (words > 0)
    y[dup | recurs] = 0
    content = np.bincount(which[(y == 1) & (words > 0)], minlength=which.max() + 1) > 0
    y[content[which] & (words > 0) & ~dup & ~recurs] = 1
    at = np.maximum.accumulate(np.where((words > 0) | np.append(True, ~inner), np.arange(len(y)), 0))
    return y[at]


def sampled_labels(labels: DataFrame, label: str, in_training: Column, per_class: int) -> DataFrame:
    """Up to per_class rows of each label, picked by a hash of the id: the same rows however the table is split."""
    rows = labelled(labels, label, in_training)
    pick = lambda v: rows.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    return pick(1).unionByName(pick(0)).select("doc_id", "y")


def train_field(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> LineField:
    """The field of a bounded sample of documents, all their lines, labelled by line_labels() from `quality`."""
    some = sampled_labels(labels, "quality", F.lit(True), per_class)
    texts = documents.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # 2 * per_class ids at most

    def of(batch: pa.RecordBatch):
        for part, data, offsets in chunks(batch, "text"):
            stats = document_stats(data, offsets)
            cut = lambda v: np.split(v, np.searchsorted(stats["line_doc"], np.arange(1, part.num_rows)))  # noqa: B023, E731
            yield {"doc_id": part.column("doc_id"), "y": part.column("y"), "x": [r.ravel() for r in cut(stats["line_x"])], "name": cut(stats["line_name"].view(np.int64)), "dup": cut(stats["line_dup"]), "words": cut(stats["line_words"])}

    rows = arrow_map(texts.select("doc_id", "y", "text"), of, "doc_id long, y int, x array<float>, name array<long>, dup array<boolean>, words array<long>").toPandas()
    if rows.empty:
        return fit_field(np.zeros((0, N_LINE_FEATURES)), np.zeros(0, np.int64), np.zeros(0, np.int64))
    rows = rows.assign(key=[tuple(n) for n in rows["name"]]).sort_values(["doc_id", "key"])
    sizes = [len(n) for n in rows["name"]]
    owner = np.repeat(np.arange(len(rows)), sizes)
    x = np.concatenate([np.asarray(v, np.float64).reshape(-1, N_LINE_FEATURES) for v in rows["x"]])
    name, dup, words = (np.concatenate([np.asarray(v, kind) for v in rows[c]]) for c, kind in (("name", np.int64), ("dup", bool), ("words", np.int64)))
    return fit_field(x, owner, line_labels(owner, np.repeat(rows["y"].to_numpy(), sizes), name.view(np.uint64), dup, words))


def apply_rules(documents: DataFrame, field: LineField, least_content: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share.

    base_failed: under 10 words, or over a fifth of the words in repeated 5-word windows. kept: not
    base_failed, and at least `least_content` of the words stand on lines decoded as content. A null
    or empty text has no words and fails; ids may be null or repeat; other columns are not read.
    """

    def of(batch: pa.RecordBatch):
        for part, data, offsets in chunks(batch, "text"):
            s = document_stats(data, offsets)
            content = field.decode(s["line_x"].astype(np.float64), s["line_doc"])
            on = np.bincount(s["line_doc"], weights=content * s["line_words"], minlength=part.num_rows)
            n = s["n_words"]
            failed = (n < 10) | (100 * s["n_repeat_words"] > 20 * n)
            share = on / np.maximum(n, 1)
            yield {
                "doc_id": part.column("doc_id"),
                **{c: s[c].astype(np.int64) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
                "base_failed": failed,
                "kept": ~failed & (share >= least_content),
                "content_share": share,
            }

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"
    return arrow_map(documents.select("doc_id", "text"), of, schema)


def quality_rules(documents: DataFrame, labels: DataFrame, least_content: float = 0.5) -> DataFrame:
    """apply_rules() with a field that is learned from the documents that `labels` covers.

    Without labels of both classes every line is content. Labels may be null, repeat or name no document.
    """
    return apply_rules(documents, train_field(documents, labels), least_content)
