"""Merge-type (BPE) encoding of a SentencePiece model by backtracking, exact, and its decoding.

A text is its encoding iff no two adjacent tokens would have merged across their border, so an encoding
is found by a search: take the longest piece at a position (Aho-Corasick), keep it if it and the token
before it stay apart when both are merged anew, else try the next shorter piece, else step back and mark
the position as failed. The search runs over many words at once: what each step looks up is an array.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd

from .common import span_names
from .packing import REMEMBERED_WORDS, WordTokenizer, _slices

SPACE, MARK = "▁", "▁".encode()
#: Bytes up to which words are searched side by side; longer ones are searched one by one.
LONG_WORD = 96
_NONE = -1


class Lookup:
    """Values of integer keys of at most 62 bits in an open-addressed array; an absent key gives -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, _NONE, np.int64), np.full(1 << bits, _NONE, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == _NONE]
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], values[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(_NONE))
        more = np.flatnonzero((found != keys) & (found != _NONE))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            found = self.keys[at[more]]
            hit = found == keys[more]
            out[more[hit]] = self.values[at[more[hit]]]
            more = more[~hit & (found != _NONE)]
        return out


class Pieces:
    """What a model file says: pieces, their order of merging, and which tokens are found where."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kind = model.normalizer_spec, type(model.pieces[0])
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("a merge-type model without normalisation and with a leading space is asked for")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("user-defined or unused pieces are not covered")
        self.size = len(model.pieces)
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN), 0)
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.byte_ids = np.full(256, self.unknown, np.int64)
        self.bytes_of: list[bytes] = [b""] * self.size
        self.is_byte = np.zeros(self.size, bool)
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = i
                self.bytes_of[i], self.is_byte[i] = bytes([int(p.piece[3:-1], 16)]), True
            elif p.type == kind.NORMAL:
                self.bytes_of[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kind.UNKNOWN:
                self.bytes_of[i] = " ⁇ ".encode()
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("pieces with a space inside: words cannot be parted there")
        score = {p: model.pieces[i].score for p, i in normal.items()}
        order = sorted((p for p in normal if len(p) > 1), key=lambda p: (-score[p], normal[p]))
        self.normal, self.rank_of = normal, {p: k for k, p in enumerate(order)}
        self.runs = {len(p) for p in normal if set(p) == {SPACE}}
        several = {SPACE * n for n in self.runs if n > 1}
        rest = [score[p] for p in order if p not in several]
        if len(set(rest)) < len(rest) or any(score[p] >= min(rest, default=0) for p in several) or len({score[p] for p in several}) > 1 or 1 not in self.runs:
            raise ValueError("pieces that merge at the same time")
        self.one = {p for p in normal if len(p) == 1}
        self._splits([p for p in order if p not in several])
        self._automaton()

    def _splits(self, order: list[str]) -> None:
        """The last merge of each piece when it is merged from its characters; pieces that do not come about are never tokens."""
        normal, rank = self.normal, self.rank_of
        n = self.size
        self.left, self.right, self.rank = np.arange(n), np.arange(n), np.full(n, _NONE, np.int64)
        self.reached = {p: normal[p] for p in self.one}
        for p in order:
            symbols, last = list(p), None
            while len(symbols) > 1:
                best, at = min((rank.get(a + b, n), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
                if best == n:
                    break
                last = symbols[at : at + 2]
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            if len(symbols) == 1:
                i = normal[p]
                self.reached[p], self.rank[i] = i, rank[p]
                self.left[i], self.right[i] = (normal[x] for x in last)
                if max(self.rank[self.left[i]], self.rank[self.right[i]]) >= rank[p]:
                    raise ValueError(f"the piece {p} merges before its parts")
        # every way to merge two symbols, also those that are no last merge of a piece
        both = [(normal[p[:k]], normal[p[k:]], rank[p]) for p in order for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
        a, b, r = np.array(both, np.int64).reshape(-1, 3).T
        self.merged = Lookup(a * n + b, r)
        self.merged_one = {(int(x), int(y)): int(z) for x, y, z in both}
        self.length = np.array([len(x) for x in self.bytes_of], np.int64)
        self.shorter = np.full(n, _NONE, np.int64)
        for p, i in self.reached.items():
            self.shorter[i] = next((self.reached[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.reached), _NONE)

    def _automaton(self) -> None:
        """Aho-Corasick over the pieces read backwards: read from a word's end, the state at a byte knows the longest piece that begins there."""
        goto: list[dict[int, int]] = [{}]
        own = [_NONE]
        for p, i in self.reached.items():
            state = 0
            for byte in reversed(p.replace(SPACE, " ").encode()):
                following = goto[state].get(byte)
                if following is None:
                    following = goto[state][byte] = len(goto)
                    goto.append({})
                    own.append(_NONE)
                state = following
            own[state] = i
        fail, queue = [0] * len(goto), list(goto[0].values())
        for state in queue:
            for byte, following in goto[state].items():
                back = fail[state]
                while back and byte not in goto[back]:
                    back = fail[back]
                fail[following] = goto[back].get(byte, 0)
                queue.append(following)
            if own[state] == _NONE:
                own[state] = own[fail[state]]
        edges = np.array([(s << 8 | byte, t) for s, row in enumerate(goto) for byte, t in row.items()], np.int64)
        self.goto, self.fail, self.found = Lookup(edges[:, 0], edges[:, 1]), np.array(fail), np.array(own)

    # --- the search, side by side ---

    def longest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The longest piece that begins at each byte of the words, which is none inside a character."""
        out = np.full(len(data), _NONE, np.int64)
        order = np.argsort(starts - ends, kind="stable")
        at, length = ends[order], (ends - starts)[order]
        state = np.zeros(len(order), np.int64)
        live = len(order)
        for k in range(1, int(length.max(initial=0)) + 1):
            live = int(np.searchsorted(-length[:live], -k, "right"))
            here = at[:live] - k
            byte = data[here].astype(np.int64)
            state = state[:live]
            following = self.goto(state << 8 | byte).astype(np.int64)
            lost = np.flatnonzero((following < 0) & (state > 0))
            back = state[lost]
            while len(lost):
                back = self.fail[back]
                again = self.goto(back << 8 | byte[lost]).astype(np.int64)
                following[lost] = again
                more = (again < 0) & (back > 0)
                lost, back = lost[more], back[more]
            state = np.maximum(following, 0)
            out[here] = self.found[state]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Do tokens a and b stay two when their characters are merged anew? Merges are taken back, the latest first;
        between two of them the symbols at the border must not merge before the next one. Of equal merges the left one is first."""
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            r = self.merged(a * self.size + b)
            crossed = (r >= 0) & (r < limit)
            out[live[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def search(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all words end to end, how many each has, and which words were found; they have known characters and at most a leading space."""
        match = self.longest(data, starts, ends)
        shift = np.arange(len(starts))  # a word has a place more than bytes: its end
        at_byte = np.full(len(data) + len(starts) + 1, _NONE, np.int64)
        at_byte[np.arange(len(data)) + np.repeat(shift, ends - starts)] = match
        begin, end = starts + shift, ends + shift
        ended = np.full(len(at_byte), _NONE, np.int64)  # the token that ends at a place
        failed = np.zeros(len(at_byte), bool)
        solved = np.zeros(len(starts), bool)
        word = np.flatnonzero((ends > starts) & (at_byte[begin] >= 0))
        place, token = begin[word], at_byte[begin[word]]
        while len(word):
            none = token < 0
            if none.any():
                failed[place[none]] = True
                lost = none & (place == begin[word])
                back = none & ~lost
                before = ended[place[back]]
                place[back] -= self.length[before]
                token[back] = self.shorter[before]
                keep = ~lost & (token >= 0) | back
                word, place, token = word[keep], place[keep], token[keep]
                if not len(word):
                    break
            live = np.flatnonzero(token >= 0)
            to, last = place[live] + self.length[token[live]], ended[place[live]]
            fits = ~failed[to]
            check = np.flatnonzero(fits & (place[live] > begin[word[live]]))
            fits[check] = self.apart(last[check], token[live[check]])
            good, bad = live[fits], live[~fits]
            ended[to[fits]] = token[good]
            place[good] = to[fits]
            token[bad] = self.shorter[token[bad]]
            token[good] = at_byte[place[good]]
            done = np.zeros(len(word), bool)
            done[good] = place[good] == end[word[good]]
            solved[word[done]] = True
            word, place, token = word[~done], place[~done], token[~done]
        tokens = np.full(len(at_byte), _NONE, np.int64)
        word = np.flatnonzero(solved)
        place = end[word]
        while len(word):
            token = ended[place]
            place = place - self.length[token]
            tokens[place] = token
            more = place > begin[word]
            word, place = word[more], place[more]
        there = tokens >= 0
        before = np.concatenate([[0], np.cumsum(there)])
        return tokens[there], before[end] - before[begin], solved

    # --- the search, one text at a time ---

    def _apart_one(self, a: int, b: int) -> bool:
        known = self._known.get((a, b))
        if known is None:
            if len(self._known) > 200_000:
                self._known.clear()
            known = self._known[a, b] = bool(self.apart(np.array([a]), np.array([b]))[0])
        return known

    _known: dict[tuple[int, int], bool] = {}

    @property
    def _scanner(self):
        """The same automaton for one long text, forwards, in C."""
        import ahocorasick

        if not hasattr(self, "_scan"):
            self._scan = ahocorasick.Automaton()
            for p, i in self.reached.items():
                self._scan.add_word(p, (len(p) - 1, i))
            self._scan.make_automaton()
        return self._scan

    def _word(self, word: str) -> list[int]:
        """One word of known characters, of any length."""
        longest = [_NONE] * len(word)
        for end, (back, token) in self._scanner.iter(word):
            longest[end - back] = token  # of one beginning the longer piece ends later
        chars = self._chars
        failed = bytearray(len(word) // 8 + 1)  # a bit a position
        out, place, token = [], 0, longest[0]
        while place < len(word):
            while token != _NONE:
                to = place + chars[token]
                if not failed[to >> 3] >> (to & 7) & 1 and (not out or self._apart_one(out[-1], token)):
                    break
                token = int(self.shorter[token])
            if token != _NONE:
                out.append(token)
                place = to
                token = longest[place] if place < len(word) else _NONE
            else:
                failed[place >> 3] |= 1 << (place & 7)
                before = out.pop()  # the first character alone is always possible
                place -= chars[before]
                token = int(self.shorter[before])
        return out

    @property
    def _chars(self) -> list[int]:
        if not hasattr(self, "_n_chars"):
            self._n_chars = [len(x.decode(errors="replace")) for x in self.bytes_of]
        return self._n_chars

    def _spaces(self, n: int) -> list[int]:
        """A run of spaces: all its merges have one score, so the leftmost that is possible is next."""
        done: list[int] = []
        while n:
            now, n = 1, n - 1
            while True:
                if done and done[-1] + now in self.runs:
                    now += done.pop()
                elif n and now + 1 in self.runs:
                    now, n = now + 1, n - 1
                else:
                    break
            done.append(now)
        return [self.normal[SPACE * k] for k in done]

    def encode_marked(self, text: str) -> list[int]:
        """A text whose spaces are marks already, nothing put before it."""
        out: list[int] = []
        at, n = 0, len(text)
        while at < n:
            if text[at] not in self.one and text[at] != SPACE:
                out += self.byte_ids[list(text[at].encode())].tolist()  # unknown characters stand between words as their bytes
                at += 1
                continue
            spaces = at
            while spaces < n and text[spaces] == SPACE:
                spaces += 1
            to = spaces
            while to < n and text[to] != SPACE and text[to] in self.one:
                to += 1
            run = spaces - at
            word = self._word(SPACE * (run > 0) + text[spaces:to]) if to > spaces else []
            if run and word and word[0] != self.normal[SPACE]:
                run -= 1  # the last space went to the word: spaces merge with each other after all else, from the left
            elif word and run:
                word = word[1:]
            out += self._spaces(run) + word
            at = to
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_marked(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 become U+FFFD one by one; the space put before the text goes. Control ids have no text."""
        out, held = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(held):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(held[at : at + size]).decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    at += 1
            held.clear()

        first = True
        for i in ids:
            if self.is_byte[i]:
                held += self.bytes_of[i]
                first = False
                continue
            flush()
            text = self.bytes_of[i].decode()
            out.append(text[1:] if first and text[:1] == " " and i != self.unknown else text)
            first = first and not text
        flush()
        return "".join(out)


class PieceEncoder(WordTokenizer):
    """Encodes chunks of texts. Between words nothing merges, so a text's ids are those of its words in turn;
    words that come again are looked up by name."""

    def __init__(self, path: str):
        self.model = Pieces(path)
        known = np.ones(256, bool)
        known[:128] = [chr(i) in self.model.one or i == 32 for i in range(128)]
        self.stops = ~known  # ASCII characters without a piece: words end there
        self._forget()

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(length)
        easy = np.array([len(w) <= LONG_WORD and w[1:2] != b" " for w in words], bool)
        at, bounds = _slices((ends - length)[easy], length[easy])
        ids, sizes, solved = self.model.search(data[at], bounds[:-1], bounds[1:])
        size = np.zeros(len(words), np.int64)
        size[np.flatnonzero(easy)[solved]] = sizes[solved]
        easy[np.flatnonzero(easy)[~solved]] = False
        base = np.zeros(len(words), np.int64)
        base[easy] = np.cumsum(size[easy]) - size[easy]
        alone = [np.array(self.model.encode_marked(words[i].decode(errors="replace").replace(" ", SPACE)), np.int64) for i in np.flatnonzero(~easy).tolist()]
        some = np.array([len(x) for x in alone], np.int64)
        size[~easy], base[~easy] = some, len(ids) + np.cumsum(some) - some
        return np.concatenate([ids, *alone]).astype("<u4"), base, size

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end and the n+1 offsets; each text that is not empty begins with the space put before it."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        if len(self.size) > REMEMBERED_WORDS:
            self._forget_rare()
        space, stop = data == 32, self.stops[data]
        begin = space | stop
        begin[1:] &= ~space[:-1] | stop[1:]
        begin[1:] |= stop[:-1]
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        which, different = pd.factorize(span_names(data, starts, ends))
        at = np.zeros(len(different), np.int64)
        at[which[::-1]] = np.arange(len(which))[::-1]
        rows = self._rows(data, np.asarray(different), starts[at], ends[at])[which]
        place, after = _slices(self.base[rows], self.size[rows])
        return self.ids[place], after[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)
