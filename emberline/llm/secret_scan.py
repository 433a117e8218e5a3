"""Secret scans by one combined deterministic automaton.

Every rule is a head and a run: a regular expression followed by one or more characters of a class.
All rules become one NFA, subset construction and minimisation make a DFA of transition arrays over
byte classes, and one pass over a text's bytes finds the ends of all rules' matches. The start of a
match is where a reversed automaton reaches furthest back, its end where the run stops. Matches are
leftmost and do not overlap within a rule; rules are independent of each other.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str  #: what stands before the run; must not occur within itself
    run: str  #: the run's characters, at least one
    least: int = 1  #: a match counts if its run has this many
    least_all: int = 1  #: and the whole match this many
    scan_least: int = 1  #: runs shorter than this are passed over by the automaton


#: Fixed patterns, in the order in which spans at one place are listed.
BASE_RULES = (
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]", least=6),
    Rule("access", r"AKIA", r"[A-Z0-9]", least_all=20),
    Rule("hex", r"", r"[0-9a-f]", least_all=24, scan_least=24),
)
ADDED_RULES = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]", least=36),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]", least=10),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY----", r"-"),
)
RULES = BASE_RULES + ADDED_RULES


class _Nfa:
    """Thompson construction from Python's own parse of a pattern."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append([])
        return len(self.empty) - 1

    def add(self, items, start: int, fold: bool = False) -> int:
        for op, value in items:
            start = self.add_one(str(op), value, start, fold)
        return start

    def add_one(self, op: str, value, start: int, fold: bool) -> int:
        if op in ("LITERAL", "IN"):
            bytes_ = set()
            for kind, v in [(op, value)] if op == "LITERAL" else value:
                if str(kind) not in ("LITERAL", "RANGE"):
                    raise ValueError(f"not supported in a rule: {kind}")
                bytes_ |= {v} if str(kind) == "LITERAL" else set(range(v[0], v[1] + 1))
            if fold:
                bytes_ |= {b ^ 32 for b in bytes_ if 65 <= b & ~32 <= 90}
            if max(bytes_) > 127:
                raise ValueError("rules are ASCII")
            end = self.state()
            self.step[start].append((frozenset(bytes_), end))
            return end
        if op == "BRANCH":
            end = self.state()
            for option in value[1]:
                inner = self.state()
                self.empty[start].append(inner)
                self.empty[self.add(option, inner, fold)].append(end)
            return end
        if op == "SUBPATTERN":
            return self.add(value[3], start, fold or bool(value[1] & re.I))
        if op == "MAX_REPEAT":
            low, high, items = value
            for _ in range(low):
                start = self.add(items, start, fold)
            end = self.state()
            self.empty[start].append(end)
            if str(high) == "MAXREPEAT":
                loop = self.state()
                self.empty[end].append(loop)
                self.empty[self.add(items, loop, fold)].append(end)
            else:
                for _ in range(high - low):
                    start = self.add(items, start, fold)
                    self.empty[start].append(end)
            return end
        raise ValueError(f"not supported in a rule: {op}")

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _parsed(pattern: str):
    return list(re._parser.parse(pattern))


def _reversed(items) -> list:
    out = []
    for op, value in reversed(items):
        if str(op) == "BRANCH":
            value = (value[0], [_reversed(list(x)) for x in value[1]])
        elif str(op) == "SUBPATTERN":
            value = (*value[:3], _reversed(list(value[3])))
        elif str(op) == "MAX_REPEAT":
            value = (*value[:2], _reversed(list(value[2])))
        out.append((op, value))
    return out


class Automaton:
    """A minimal DFA of several expressions. `table[state + class]` is the next state times the number
    of classes; states from `accepting` on accept the rules in `rules_of`."""

    def __init__(self, expressions: list[list], anywhere: bool):
        nfa = _Nfa()
        starts, final = [], {}
        for rule, items in enumerate(expressions):
            starts.append(nfa.state())
            final[nfa.add(items, starts[-1])] = rule
        again = nfa.closure(starts)
        cells = {}  # bytes that no step tells apart are one class
        for byte in range(256):
            key = tuple(byte in chars for state in nfa.step for chars, _ in state) if byte < 128 else ()
            cells.setdefault(key, []).append(byte)
        plain = tuple(False for state in nfa.step for _ in state)
        if plain in cells and () in cells:
            cells[plain] += cells.pop(())
        groups = list(cells.values())
        # subset construction
        index, table, todo = {again: 0}, [], [again]
        while todo:
            here = todo.pop(0)
            row = []
            for group in groups:
                to = {end for s in here for chars, end in nfa.step[s] if group[0] in chars}
                to = nfa.closure(to) | (again if anywhere else frozenset())
                if to not in index:
                    index[to] = len(index)
                    todo.append(to)
                row.append(index[to])
            table.append(row)
        accepts = [frozenset(final[s] for s in states if s in final) for states in index]
        # minimisation: split blocks of states until all states of a block step to the same blocks
        block = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
        block = [block[a] for a in accepts]
        while True:
            keys = [(b, *(block[t] for t in row)) for b, row in zip(block, table, strict=True)]
            names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            block, before = [names[k] for k in keys], len(set(block))
            if len(names) == before:
                break
        first = {b: s for s, b in reversed(list(enumerate(block)))}
        order = sorted(first, key=lambda b: (bool(accepts[first[b]]), first[b]))
        place = {b: i for i, b in enumerate(order)}
        n = len(groups)
        self.table = [place[block[t]] * n for b in order for t in table[first[b]]]
        self.start = place[block[0]] * n
        self.accepting = sum(not accepts[first[b]] for b in order) * n
        self.rules_of = {place[b] * n: accepts[first[b]] for b in order if accepts[first[b]]}
        dead = [b for b in order if not accepts[first[b]] and all(block[t] == b for t in table[first[b]])]
        self.dead = place[dead[0]] * n if dead and not anywhere else -1
        self.classes = bytes(next(i for i, g in enumerate(groups) if byte in g) for byte in range(256))

    def ends(self, text: bytes) -> list[tuple[int, int]]:
        """(position after it, accepting state) wherever some rule's match may end."""
        table, accepting, state, out = self.table, self.accepting, self.start, []
        for i, c in enumerate(text.translate(self.classes), 1):
            state = table[state + c]
            if state >= accepting:
                out.append((i, state))
        return out

    def longest(self, codes: bytes, at: int, stop: int, step: int = 1) -> int:
        """Length of the longest match of codes[at:stop:step] from its start, or -1; codes are a text translated to classes."""
        table, accepting, state, dead = self.table, self.accepting, self.start, self.dead
        best = at if state >= accepting else at - step
        for i in range(at, stop, step):
            state = table[state + codes[i]]
            if state >= accepting:
                best = i + step
            elif state == dead:
                break
        return (best - at) * step


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        run = lambda r, n: _parsed(f"{r.run}{{{n},}}" if n > 1 else f"{r.run}+")
        self.all = Automaton([_parsed(r.head) + run(r, r.scan_least) for r in rules], anywhere=True)
        self.back = [Automaton([_reversed(_parsed(r.head) + run(r, 1))], anywhere=False) for r in rules]
        self.heads = [Automaton([_parsed(r.head)], anywhere=False) for r in rules]
        self.runs = [Automaton([run(r, 1)], anywhere=False) for r in rules]

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) of all matches, by start and then by rule; byte offsets, end exclusive."""
        done, out = [0] * len(self.rules), []
        codes: dict[Automaton, bytes] = {}  # one translation of the whole text for each automaton that is asked

        def longest(automaton: Automaton, at: int, stop: int, step: int = 1) -> int:
            if automaton not in codes:
                codes[automaton] = text.translate(automaton.classes)
            return automaton.longest(codes[automaton], at, stop, step)

        for end, state in self.all.ends(text):
            for r in self.all.rules_of[state]:
                if end <= done[r]:
                    continue
                back = longest(self.back[r], end - 1, done[r] - 1, -1)
                if back <= 0:
                    continue
                start = end - back
                head = longest(self.heads[r], start, end)
                stop = start + head + longest(self.runs[r], start + head, len(text))
                done[r] = stop
                rule = self.rules[r]
                if stop - start - head >= rule.least and stop - start >= rule.least_all:
                    out.append((start, stop, r))
        return sorted(out, key=lambda x: (x[0], x[2]))

    def found(self, text: str | None) -> list[tuple[int, int, int]]:
        """spans() in code points."""
        data = (text or "").encode()
        out, at, chars = [], 0, 0
        places = {}
        spans = self.spans(data)
        if spans and len(data) != len(text):
            for place in sorted({p for s in spans for p in s[:2]}):
                chars += len(data[at:place].decode())
                at = place
                places[place] = chars
        for start, end, r in spans:
            out.append((places.get(start, start), places.get(end, end), r))
        return out


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id") -> DataFrame:
    """id, and spans: an array of (start, end, kind) in code points, by start and then in the rules' order.

    A null text is an empty one and has no spans. Ids may be null or repeat; other columns are not read.
    """
    scanner = Scanner(rules)
    kinds = [r.kind for r in rules]

    def of(batch: pa.RecordBatch):
        found = [scanner.found(t) for t in batch.column("text").to_pylist()]
        yield {"id": batch.column("id"), "spans": [[{"start": a, "end": b, "kind": kinds[r]} for a, b, r in x] for x in found]}

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.selectExpr(f"`{id_column}` AS id", "text")
    return arrow_map(rows, of, f"id {kind}, spans array<struct<start:long,end:long,kind:string>>").withColumnRenamed("id", id_column)


def digest(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined).

    A null or empty text has no spans; texts of any length are scanned whole, in time that grows with
    their length; ids may be null or repeat, each row is its own; an empty table gives an empty result;
    other columns are not read.
    """
    scanner = Scanner(rules)
    base = {r.kind for r in BASE_RULES}

    def of(batch: pa.RecordBatch):
        out = {c: [] for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in batch.column("text").to_pylist():
            said = [(rules[r].kind, f"{rules[r].kind}:{a}:{b}") for a, b, r in scanner.found(text)]
            for k in base:
                out[f"n_{k}"].append(sum(kind == k for kind, _ in said))
            out["base_sha256"].append(hashlib.sha256(",".join(s for kind, s in said if kind in base).encode()).hexdigest())
            out["spans"].append(",".join(s for _, s in said))
        yield {"doc_id": batch.column("doc_id"), **out}

    return arrow_map(documents.select("doc_id", "text"), of, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(documents: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """documents with every span of `text` (overlapping ones together) replaced by `mark`, and n_chars,
    where there is such a column, set to the new length of a changed text. All other columns stay.

    A null text stays null; rows may repeat; an empty table gives an empty one."""
    scanner = Scanner(rules)
    names = documents.columns

    def clean(text: str | None) -> str | None:
        out, at = [], 0
        for start, end, _ in scanner.found(text):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join(out) + text[at:] if out else text

    def of(batch: pa.RecordBatch):
        before = batch.column("text").to_pylist()
        after = [clean(t) for t in before]
        columns = {c: batch.column(c) for c in names} | {"text": after}
        if "n_chars" in names:
            columns["n_chars"] = [n if a == b else len(b) for n, a, b in zip(batch.column("n_chars").to_pylist(), before, after, strict=True)]
        yield columns

    return arrow_map(documents, of, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema))
