"""Counts over whole texts and their lines, for a chunk of documents at a time."""

from __future__ import annotations

import numpy as np

from .common import gram_hashes, mix, span_names, word_bounds

#: Features of a document and of a line.
N_FEATURES, N_LINE_FEATURES = 20, 15

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _sums(mask: np.ndarray, bounds_from: np.ndarray, bounds_to: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds_to] - total[bounds_from]


def _seen_before(group: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash within its group: is it there twice or more; is it there earlier."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    key = mix(hashes + group.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return counts[inverse] > 1, first[inverse] != np.arange(len(key))


def _equal_lines(data: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of lines, and whether a line is equal to an earlier one of its document: those of one name are compared byte by byte."""
    name = span_names(data, start, end)
    order = np.lexsort((np.arange(len(name)), name, doc))
    same = np.append(False, (name[order][1:] == name[order][:-1]) & (doc[order][1:] == doc[order][:-1]))
    earlier = np.zeros(len(name), bool)
    view, seen = data.tobytes() if same.any() else b"", {}
    for i in np.flatnonzero(same).tolist():
        line, before = order[i], order[i - 1]
        if not same[i - 1]:  # the first line of this name in this document
            seen = {view[start[before] : end[before]]}
        text = view[start[line] : end[line]]
        earlier[line] = text in seen
        seen.add(text)
    return name, earlier


def document_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Per document: words, word_chars, symbols, dup_lines, repeat_words, chars and shares used as
    features; per line (line_*): its document and features. A text without a newline is one line,
    an empty text one empty line."""
    n = len(offsets) - 1
    lo, hi = offsets[:-1], offsets[1:]
    starts, ends, first = word_bounds(data, offsets)
    words = span_names(data, starts, ends)
    doc_of_word = np.repeat(np.arange(n), np.diff(first))
    whole = (data & 0xC0) != 0x80
    space = (data == 32) | ((data >= 9) & (data <= 13))

    grams, bounds = gram_hashes(words, first, 5)
    doc_of_gram = np.repeat(np.arange(n), np.diff(bounds))
    twice, _ = _seen_before(doc_of_gram, grams)
    covers = np.zeros(len(words) + 1, np.int64)
    at = (np.arange(len(grams)) - bounds[doc_of_gram] + first[doc_of_gram])[twice] if len(grams) else np.zeros(0, np.int64)
    np.add.at(covers, at, 1)
    np.add.at(covers, at + 5, -1)
    covered = np.cumsum(covers[:-1]) > 0

    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, np.concatenate([lo, breaks]), "right") - 1
    owner[:n] = np.arange(n)
    order = np.lexsort((np.arange(len(owner)) >= n, np.concatenate([lo, breaks + 1]), owner))
    line_doc = owner[order]
    line_start = np.concatenate([lo, breaks + 1])[order]
    line_end = np.concatenate([line_start[1:] - 1, hi[-1:]]) if n else line_start
    last = np.append(line_doc[1:] != line_doc[:-1], True) if n else np.zeros(0, bool)
    line_end[last] = hi[line_doc[last]]
    line_words = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
    line_name, earlier = _equal_lines(data, line_doc, line_start, line_end)
    dup = earlier & (line_words > 0)

    upper, digit, symbol = _UPPER[data], _DIGIT[data], _SYMBOL[data]
    loud = (data == 33) | (data == 63)
    full = (data == 46) | (data == 44)
    per = lambda mask: _sums(mask, lo, hi)
    line = lambda mask: _sums(mask, line_start, line_end)
    chars = np.maximum(line(whole), 1)
    count = np.maximum(line_words, 1)
    tail = np.where(line_end > line_start, data[np.maximum(line_end - 1, 0)] if len(data) else 0, 0)
    line_x = np.stack(
        [
            np.ones(len(line_doc)),
            np.log1p(line_words) / 5,
            line_words == 0,
            line_words == 1,
            (line_words > 1) & (line_words < 5),
            np.minimum(line(symbol) / count, 3) / 3,
            line(upper) / chars,
            line(digit) / chars,
            np.minimum(line(loud) / count, 2) / 2,
            np.minimum(line(data == 124) / count, 1),
            np.minimum(line(full) / count, 1),
            np.minimum(chars / count / 10, 3) / 3,
            dup,
            (tail == 46) | (tail == 33) | (tail == 63),
            _sums(covered, np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)) / count,
        ],
        axis=1,
    ).astype(np.float32)

    n_words = np.diff(first)
    sums = lambda mask: _sums(mask, first[:-1], first[1:])
    n_lines = np.bincount(line_doc, minlength=n)
    distinct = sums(~_seen_before(doc_of_word, words)[1])
    length = ends - starts
    stats = {
        "n_words": n_words,
        "word_chars": per(whole & ~space),
        "n_symbols": per(symbol),
        "n_dup_lines": np.bincount(line_doc[dup], minlength=n),
        "n_repeat_words": sums(covered),
        "line_doc": line_doc,
        "line_x": line_x,
        "line_words": line_words,
        "line_name": line_name,
        "line_dup": dup,
    }
    w, c = np.maximum(n_words, 1), np.maximum(per(whole), 1)
    stats["x"] = np.stack(
        [
            np.log1p(n_words) / 8,
            n_words < 5,
            n_words < 10,
            n_words < 30,
            np.minimum(stats["n_symbols"] / w, 3),
            per(upper) / c,
            per(digit) / c,
            np.minimum(per(loud) / w, 2),
            np.minimum(per(data == 124) / w, 1),
            np.minimum(per(full) / w, 1),
            np.minimum(stats["word_chars"] / w / 10, 3),
            sums(length > 25) / w,
            sums(length < 4) / w,
            distinct / w,
            stats["n_dup_lines"] / np.maximum(n_lines, 1),
            stats["n_repeat_words"] / w,
            np.minimum(n_lines / w, 1),
            np.minimum(per(data >= 0xC0) / c, 1),
            np.sqrt(stats["n_repeat_words"] / w),
            stats["n_repeat_words"] > 0.2 * w,
        ],
        axis=1,
    ).astype(np.float32)
    return stats
