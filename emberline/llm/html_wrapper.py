"""Main text of web pages by wrappers inferred from pages of one host.

A page is a token stream of tags and texts. A host's wrapper is a union-free regular expression over
such tokens: it starts as one page and is aligned with others in turn. Neighbouring elements that
are alike become a repeated group, elements that some pages lack an optional one, texts that differ a
text slot. Elements keep the alignment balanced: what is aligned are the children of elements that
were aligned themselves. An element of the wrapper also keeps the texts that stand in it on every page that
has it: those are template, on every page of the host and inside the article too; all other texts of its
slot vary and are content.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import math
import re
import sys
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.session import find_package

from .common import arrow_map, partitions, written

#: So many partial wrappers of a host are aligned by one task.
FAN_IN = 64
#: Longer template texts are named by their beginning and a hash.
SHOWN = 64
#: Unlike pages that must share a text before it is template: outside the article and inside it, where
#: a few pages may well say the same.
TEMPLATE_PAGES, TEMPLATE_PAGES_INSIDE = 2, 8

#: Elements nest as deep as a page says. Calls of plain Python functions take no C stack.
sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))

#: Fixed lists of HTML: elements within a line, elements without content, raw text, page furniture.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr math mfrac mi mn mo mover mrow ms msqrt mstyle msub msubsup msup mtext munder semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea title".split())
FURNITURE = frozenset("head nav footer aside form button select menu dialog header".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
OWN_KIND = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*|[^>]*)(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_FURNITURE_WORD = r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|sidebar|side|rail|nav\w*|menu\w*|breadcrumbs?|footer|header|masthead|topbar|comments?|commentlist|disqus|respond|repl(?:y|ies)|discussion|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|widgets?|toolbar|pagination|pager|contentinfo|complementary|navigation"
#: Words that say where or how a part stands, not what it is about: "left-sidebar" is furniture, "side-effects" is not.
_PLACE_WORD = r"site|page|main|global|left|right|top|bottom|bar|area|list|box|block|container|content|wrapper|wrap|inner|outer|section|form|panel|links?|buttons?|icons?|posts?|articles?|entry|items?|row|col|column|\d+"
_FURNITURE_NAME = re.compile(rf"(?:(?:{_PLACE_WORD})[-_]+)*(?:{_FURNITURE_WORD})(?:[-_]+(?:{_FURNITURE_WORD}|{_PLACE_WORD}))*", re.I)
_HEADING_NAME = re.compile(rf"(?:(?:{_PLACE_WORD})[-_]+)*header", re.I)
_MAIN_NAME = re.compile(r"(^|[-_])(article|main|post|entry|story)([-_]?(body|content|text|main))?$|^(content|main-content|article)$", re.I)


def tokens(page: str):
    """("text", s), ("start", signature) and ("end", tag) of a page; raw and commented text is left out."""
    at, skip = 0, None
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if skip:
            if m[1] and m[2].lower() == skip:
                skip, at = None, m.end()
            continue
        if m.start() > at:
            yield "text", page[at : m.start()]
        at = m.end()
        if m[0].startswith("<![CDATA["):
            yield "text", m[0][9:].removesuffix("]]>")
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            yield "end", tag
        elif tag in RAW:
            if not m[3].rstrip().endswith("/"):
                skip = tag
        else:
            names = []
            if m[3] and "=" in m[3]:
                for key, value in _NAMED.findall(m[3]):
                    names += [(" #" if key.lower() == "id" else " .") + re.sub(r"\d+", "0", v) for v in value.strip("\"'").split()]
            yield "start", tag + "".join(names)
    if not skip and at < len(page):
        yield "text", page[at:]


#: A tag, or a name with its mark. Names hold no white space: a space stands before each.
_PART = re.compile(r"[^ ]+")


def tag_of(signature: str) -> str:
    return signature.split(" ", 1)[0]


@lru_cache(maxsize=100_000)
def without_ids(signature: str) -> str:
    return " ".join(part for part in _PART.findall(signature) if part[0] != "#")


class Node:
    """An open element of a page. `unit` is the nearest element that is not within a line: a text is the
    same on two pages if all that stands in its unit is. `key` names the path of signatures."""

    __slots__ = ("furniture", "key", "main", "parent", "signature", "unit")

    def __init__(self, parent: Node | None, signature: str):
        if parent and parent.main:
            signature = without_ids(signature)
        self.parent, self.signature = parent, signature
        self.unit = parent.unit if parent and tag_of(signature) in INLINE else self
        self.furniture, self.main, self.key = judged(signature, parent.furniture, parent.main, parent.key) if parent else (False, False, "")


def texts(page: str):
    """(element, text, breaks before it) of every text of a page."""
    root = Node(None, "")
    path: list[Node] = []
    tags: list[str] = []
    broke = True
    for kind, value in tokens(page):
        if kind == "text":
            yield path[-1] if path else root, value, broke
            broke = False
            continue
        tag = tag_of(value) if kind == "start" else value
        broke |= tag not in INLINE
        if kind == "end":
            if tag in tags:
                while tags:
                    path.pop()
                    if tags.pop() == tag:
                        break
            continue
        if tag in ENDS_PARAGRAPH and "p" in tags:  # an open paragraph ends, unless something holds it
            at = len(tags) - 1 - tags[::-1].index("p")
            if not ENDS_PARAGRAPH & set(tags[at + 1 :]) and not {"button", "td", "li"} & set(tags[at + 1 :]):
                del tags[at:], path[at:]
        if tag in OWN_KIND:  # a list item or cell ends the one before it
            for at in range(len(tags) - 1, -1, -1):
                if tags[at] in OWN_KIND[tag]:
                    break
                if tags[at] == tag or {tags[at], tag} == {"dt", "dd"} or {tags[at], tag} == {"td", "th"}:
                    del tags[at:], path[at:]
                    break
        if tag not in VOID:
            tags.append(tag)
            path.append(Node(path[-1] if path else root, value))


def in_one_line(pieces: list[str]) -> str:
    return " ".join(entities.unescape("".join(pieces)).split())


def text_key(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def shown(text: str) -> str:
    return text if len(text) <= SHOWN else f"{text[: SHOWN // 2]}\u2026{text_key(text)}"


class Element:
    """An element of a wrapper: alike children are one repeated child, `optional` if some pages lack it.
    `common` are the keys of the texts that all the `pages` with this element have in it."""

    __slots__ = ("children", "common", "optional", "pages", "repeated", "signature", "text")

    def __init__(self, signature: str):
        self.signature, self.children, self.optional, self.repeated = signature, [], False, False
        self.text: str | None = ""  #: the same on all pages so far, "" for none, None for a slot
        self.pages, self.common = 1, set()

    def expression(self) -> str:
        inner = "".join(c.expression() for c in self.children)
        inner = ("#TEXT" if self.text is None else entities.escape(self.text)) + inner
        out = f"<{self.signature}>{inner}</{tag_of(self.signature)}>"
        return f"({out})+" * (self.repeated and not self.optional) or f"({out})*" * self.repeated or f"({out})?" * self.optional or out


def tree(page: str) -> Element:
    """A page as a wrapper of its own, neighbours alike folded into one repeated group."""
    root = Element("")
    elements: dict[Node, Element] = {}
    units: dict[Node, list[str]] = {}

    def of(node: Node) -> Element:
        new = []
        while node.parent and node not in elements:
            new.append(node)
            node = node.parent
        at = elements[node] if node.parent else root
        for node in reversed(new):
            elements[node] = Element(node.signature)
            at.children.append(elements[node])
            at = elements[node]
        return at

    for node, text, broke in texts(page):
        element = of(node)
        units.setdefault(node.unit, []).extend((" ", text) if broke else (text,))
        text = in_one_line([text])
        if text:
            element.text = (element.text + " " + text).strip()
    for node, pieces in units.items():
        text = in_one_line(pieces)
        if text:
            of(node).common.add(text_key(text))
    for element in (root, *elements.values()):
        element.text = shown(element.text)
    return fold(root)


def dumps(wrapper: Element) -> str:
    """A wrapper as text: its elements from the root on, each with the number of its children."""
    out, todo = [], [wrapper]
    while todo:
        e = todo.pop()
        out.append([e.signature, int(e.optional), int(e.repeated), e.text, e.pages, sorted(e.common), len(e.children)])
        todo += reversed(e.children)
    return json.dumps(out)


def loads(said: str) -> Element:
    rows = json.loads(said)
    root, open_elements = Element(""), []
    for at, (signature, optional, repeated, text, pages, common, n) in enumerate(rows):
        e = Element(signature) if at else root
        e.optional, e.repeated, e.text, e.pages, e.common = bool(optional), bool(repeated), text, pages, set(common)
        if at:
            while not open_elements[-1][1]:
                open_elements.pop()
            open_elements[-1][0].children.append(e)
            open_elements[-1][1] -= 1
        open_elements.append([e, n])
    return root


def fold(element: Element) -> Element:
    """Neighbours alike become one repeated group."""
    out: list[Element] = []
    for child in element.children:
        fold(child)
        if out and out[-1].signature == child.signature:
            align(out[-1], child, PAGE)
            out[-1].repeated = True
        else:
            out.append(child)
    element.children = out
    return element


#: What two aligned elements are: parts of one page, the same part of unlike pages, parts of one wrapper.
PAGE, PAGES, WRAPPER = range(3)


#: Steps of an alignment: an item of both sequences, of the first alone, of the second alone.
BOTH, FIRST, SECOND = range(3)


def in_order(x: list[str], y: list[str]):
    """The steps of a longest common subsequence of any two sequences: x is taken first where both ways are as long.

    Row i has a bit for each item of y, from the last one on; it is 0 where the subsequence of x[i:] grows by that item.
    Rows are kept at about every square root of len(x); those between two are worked out again when the steps reach them.
    """
    many = math.isqrt(len(y)) + 1
    places: dict[str, list[int]] = {}
    for at, item in enumerate(reversed(y)):
        places.setdefault(item, []).append(at)

    def bits(item: str) -> int:
        out = bytearray(len(y) // 8 + 1)
        for at in places.get(item, ()):
            out[at >> 3] |= 1 << (at & 7)
        return int.from_bytes(out, "little")

    often = {item: bits(item) for item, at in places.items() if len(at) > many}
    full = (1 << len(y)) - 1

    def above(row: int, item: str) -> int:
        equal = row & (often[item] if item in often else bits(item))
        return (row + equal | row - equal) & full

    def length(row: int, j: int) -> int:
        n = len(y) - j
        return n - (row & ((1 << n) - 1)).bit_count()

    apart = math.isqrt(len(x)) + 1
    kept, row = {len(x): full}, full
    for i in range(len(x) - 1, -1, -1):
        row = above(row, x[i])
        if i % apart == 0:
            kept[i] = row
    rows: dict[int, int] = {}
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and i + 1 not in rows:  # the rows from here to the next one kept
            end = min(len(x), (i // apart + 1) * apart)
            rows = {end: kept[end], i: rows.get(i, kept.get(i))}
            for k in range(end - 1, i, -1):
                rows[k] = above(rows[k + 1], x[k])
        if i < len(x) and j < len(y) and x[i] == y[j]:
            yield BOTH
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and length(rows[i + 1], j) >= length(rows[i], j + 1):
            yield FIRST
            i += 1
        else:
            yield SECOND
            j += 1


def align(a: Element, b: Element, what: int = PAGES) -> Element:
    """a generalised so that it matches b as well: longest common subsequence of children, the rest optional."""
    if a.text != b.text:
        a.text = None
    if what == PAGE:
        a.common |= b.common
    else:
        a.common &= b.common
        a.pages = a.pages + b.pages if what == PAGES else max(a.pages, b.pages)
    beside = PAGE if what == PAGE else WRAPPER
    a.optional |= b.optional
    a.repeated |= b.repeated
    x, y = a.children, b.children
    if [c.signature for c in x] == [c.signature for c in y]:
        for c, d in zip(x, y, strict=True):
            align(c, d, what)
        return a
    out, i, j = [], 0, 0
    for step in in_order([c.signature for c in x], [c.signature for c in y]):
        if step == BOTH:
            out.append(align(x[i], y[j], what))
        else:
            only = x[i] if step == FIRST else y[j]
            only.optional = True
            out.append(only)
        i += step != SECOND
        j += step != FIRST
    merged: list[Element] = []
    for child in out:  # what an optional part kept apart may be alike now
        if merged and merged[-1].signature == child.signature:
            align(merged[-1], child, beside)
            merged[-1].repeated = True
        else:
            merged.append(child)
    a.children = merged
    return a


@lru_cache(maxsize=100_000)
def judged(signature: str, furniture: bool, main: bool, key: str) -> tuple[bool, bool, str]:
    """Is an element furniture, is it in a main element, and the key of its path, from those of its parent.
    Names count as a whole. In a main element ids are anchors, and a header is the article's own."""
    tag, *names = _PART.findall(signature)
    inside = main or is_main(signature)
    furniture = furniture or tag in FURNITURE and not (tag == "header" and main)
    if tag not in ("html", "body") and not furniture:
        furniture = any(_FURNITURE_NAME.fullmatch(n[1:]) and not (main and (n[0] == "#" or _HEADING_NAME.fullmatch(n[1:]))) for n in names)
    return furniture, inside, text_key(f"{key}/{signature}")


@lru_cache(maxsize=100_000)
def is_main(signature: str) -> bool:
    tag, *names = _PART.findall(signature)
    return tag in ("article", "main") or tag not in ("html", "body") and any(_MAIN_NAME.search(n[1:]) for n in names)


def infer(pages: list[str]) -> Element:
    """The wrapper of pages of one host."""
    wrapper = tree(pages[0])
    for page in pages[1:]:
        align(wrapper, tree(page))
    return wrapper


def slots(wrapper: Element) -> dict[str, list[str]]:
    """Template texts of a host: for a path's key, the keys of the texts that all pages with that element
    have there. Other texts of the host vary."""
    out: dict[str, set[str]] = {}
    todo = [(c, False, False, "") for c in wrapper.children]
    if wrapper.common and wrapper.pages >= TEMPLATE_PAGES:
        out[""] = set(wrapper.common)
    while todo:
        element, furniture, main, key = todo.pop()
        furniture, main, key = judged(element.signature, furniture, main, key)
        if furniture:
            continue
        if element.common and element.pages >= (TEMPLATE_PAGES_INSIDE if main else TEMPLATE_PAGES):
            out.setdefault(key, set()).update(element.common)
        todo += [(c, furniture, main, key) for c in element.children]
    return {k: sorted(v) for k, v in sorted(out.items())}


def main_text(page: str | None, known: dict[str, list[str]] | None = None) -> str:
    """Texts of a page that are in its article, or anywhere outside furniture if it has none, without
    the host's template texts. A page of nothing but template is taken whole."""
    found = list(texts(page or ""))
    article = any(node.main and not node.furniture for node, _, _ in found)
    template: set[Node] = set()
    if known:
        units: dict[Node, list[str]] = {}
        for node, text, broke in found:
            if node.unit.key in known:
                units.setdefault(node.unit, []).extend((" ", text) if broke else (text,))
        template = {unit for unit, pieces in units.items() if text_key(in_one_line(pieces)) in known[unit.key]}

    def chosen(without: set[Node]) -> str:
        parts, gap = [], True
        for node, text, broke in found:
            gap |= broke
            if not node.furniture and (node.main or not article) and node.unit not in without:
                parts += [" ", text] if gap else [text]
                gap = False
            else:
                gap = True
        return in_one_line(parts)

    return chosen(template) or chosen(set())


@lru_cache(maxsize=256)
def _known(wrapper: str | None) -> dict[str, list[str]]:
    return json.loads(wrapper) if wrapper else {}


def _with_host(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)).alias("host"))


def _aligned(batches):
    """Rows (host, part, wrapper) in the order of (host, part), each part's wrappers aligned to one."""
    names, target = ("host", "part", "wrapper"), pa.schema([("host", pa.string()), ("part", pa.int64()), ("wrapper", pa.string())])
    part, first, wrapper = None, "", None  # a wrapper alone in its part stays as it is
    done: list[tuple] = []
    for batch in batches:
        for host, number, said in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if (host, number) == part:
                wrapper = align(wrapper or loads(first), loads(said))
                continue
            if part:
                done.append((*part, dumps(wrapper) if wrapper else first))
            part, first, wrapper = (host, number), said, None
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), target.types, strict=True)], schema=target)
            done = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*part, dumps(wrapper) if wrapper else first), target.types, strict=True)], schema=target)


def _inferred(batches):
    """The last round's wrappers with what they say, in the same Python worker."""
    target = pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("slots", pa.string()), ("pages", pa.int64())])
    for batch in _aligned(batches):
        found = [loads(w) for w in batch.column("wrapper").to_pylist()]
        columns = batch.column("host"), [w.expression() for w in found], [json.dumps(slots(w)) for w in found], [w.pages for w in found]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, target.types, strict=True)], schema=target)


def _slices(batch: pa.RecordBatch, rows: int = 512):
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (the expression), slots (JSON of a path's key to its template texts' keys) and the
    number of unlike pages it was inferred from, which are all of the host's.

    Every page is parsed once, to a wrapper of its own; pages of one host with equal wrappers count once.
    Parts of a host, dealt by hash, are then aligned in rounds, `FAN_IN` wrappers a task and part, so that
    no task holds a host. Pages without html take no part.
    """
    find_package(pages.sparkSession)
    rows = _with_host(pages).where("html is not null and html <> ''").select("host", "html")

    def of(batch: pa.RecordBatch):
        for some in _slices(batch):
            yield {"host": some.column("host"), "wrapper": [dumps(tree(h)) for h in some.column("html").to_pylist()]}

    some = written(arrow_map(rows, of, "host string, wrapper string").groupBy("host", "wrapper").agg(F.xxhash64("wrapper").alias("hash")), "page-trees")
    parts = F.ceil(F.count("*") / FAN_IN)
    own = written(some.groupBy("host").agg(parts.alias("parts")).where("parts > 1"), "parts")  # no other host decides a host's parts
    parts = own.agg(F.max("parts")).first()[0] or 1
    order = ["hash", "wrapper"]
    some = some.join(own, "host", "left").withColumn("part", F.pmod("hash", F.coalesce("parts", F.lit(1))))
    while True:
        some = some.repartition(partitions(pages), "host", "part").sortWithinPartitions("host", "part", *order)
        some = some.select("host", "part", "wrapper")
        if parts == 1:
            return some.mapInArrow(_inferred, "host string, wrapper string, slots string, pages long")
        some = some.mapInArrow(_aligned, "host string, part long, wrapper string")
        parts = -(-parts // FAN_IN)
        order = ["before"]
        some = some.select("host", "wrapper", F.col("part").alias("before"), F.floor(F.col("part") / FAN_IN).alias("part"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty html has an empty text; a null url is the host "". Rows may repeat; other columns
    are not read; an empty table gives an empty result.
    """
    wrappers = written(infer_wrappers(pages).select(F.col("host").alias("of_host"), "slots"), "wrappers")
    rows = _with_host(pages)
    rows = rows.join(wrappers, rows["host"] == wrappers["of_host"], "left").select("page_id", "url", "html", "slots")

    def of(batch: pa.RecordBatch):
        for some in _slices(batch):
            found = [main_text(h, _known(s)) for h, s in zip(some.column("html").to_pylist(), some.column("slots").to_pylist(), strict=True)]
            yield {"page_id": some.column("page_id"), "url": some.column("url"), "text": found, "n_chars": [len(t) for t in found]}

    return arrow_map(rows, of, "page_id long, url string, text string, n_chars long")
