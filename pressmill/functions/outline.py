"""Flat outline of a page: the one place where markup is read in Python.

A page becomes its text pieces in order and, for every element, the range of pieces it
covers; ``marked`` gives the elements that an outlet's selectors name. What is chosen, joined, parsed and
fallen back to are column expressions over these arrays.
"""

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from pressmill.functions.selectors import between, covered, sheet

# Element kinds of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "big", "cite", "code", "em", "font", "i", "ins", "mark", "q", "s", "small", "span",
          "strong", "sub", "sup", "time", "u"}
SILENT = {"script", "style", "noscript", "template", "head", "title"}
# A start tag of the second kind ends an open element of the first.
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
            "table", "ul"}
SIBLING = {"li": {"ul", "ol"}, "td": {"tr"}, "tr": {"table", "tbody"}, "option": {"select"}, "dt": {"dl"}, "dd": {"dl"},
           "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
# An open element of the first kind also ends at these start tags.
ALSO_ENDS = {"dt": "dd", "dd": "dt", "tbody": "thead", "tfoot": "tbody"}
# The only elements of a head; any other start tag ends it.
HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}

OUTLINE = ("texts array<string>, tag array<string>, cls array<string>, ident array<string>, "
           "parent array<int>, last array<int>, t0 array<int>, t1 array<int>, pars array<int>, kids array<int>")
MARKED = ("texts array<string>, gone array<boolean>, containers array<struct<n:int,nested:boolean,t0:int,t1:int,b0:int,b1:int,p0:int,p1:int>>, "
          "blocks array<struct<t0:int,t1:int>>, pars array<struct<t0:int,t1:int>>, "
          "fields array<struct<kind:string,n:int,how:string,value:string,t0:int,t1:int>>")
_TEXT, _INT, _BOOL = pa.string(), pa.int32(), pa.bool_()
_SPANS = pa.list_(pa.struct([("t0", _INT), ("t1", _INT)]))
OUTLINE_FIELDS = [*((n, pa.list_(_TEXT)) for n in ("texts", "tag", "cls", "ident")),
                  *((n, pa.list_(_INT)) for n in ("parent", "last", "t0", "t1", "pars", "kids"))]
MARKED_FIELDS = [
    ("texts", pa.list_(_TEXT)), ("gone", pa.list_(_BOOL)),
    ("containers", pa.list_(pa.struct([("n", _INT), ("nested", _BOOL), *((n, _INT) for n in ("t0", "t1", "b0", "b1", "p0", "p1"))]))),
    ("blocks", _SPANS), ("pars", _SPANS),
    ("fields", pa.list_(pa.struct([("kind", _TEXT), ("n", _INT), ("how", _TEXT), ("value", _TEXT), ("t0", _INT), ("t1", _INT)])))]


class _Reader(HTMLParser):
    def __init__(self, rules=None):
        super().__init__(convert_charrefs=True)
        self.rules = rules
        self.given = []  # attributes of the open elements' path, outermost first
        self.hits = []  # (rule, node, value or None); a void element has the number of the next one
        self.raw = {}  # texts of silent elements that a rule asks for
        self.texts, self.tag, self.cls, self.ident = [], [], [], []
        self.parent, self.last, self.t0, self.t1 = [], [], [], []
        self.open = []  # element numbers, outermost first
        self.silent = 0
        self.gap = False

    def _close(self, depth):
        for n in self.open[depth:]:
            self.last[n], self.t1[n] = len(self.tag) - 1, len(self.texts)
            self.silent -= self.tag[n] in SILENT
        del self.open[depth:]
        del self.given[depth:]

    def _find(self, tag, barrier=()):
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.tag[self.open[depth]]
            if name == tag:
                return depth
            if name in barrier:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        self.gap |= tag not in INLINE
        if tag not in HEAD and (head := self._find("head")) is not None:
            self._close(head)
        if tag in CLOSES_P or tag in SIBLING:
            ends = [("p", {"td", "button"})] if tag in CLOSES_P else [(t, SIBLING[tag]) for t in (tag, ALSO_ENDS.get(tag)) if t]
            for name, barrier in ends:
                if (depth := self._find(name, barrier)) is not None:
                    self._close(depth)
        given = {k: v or "" for k, v in reversed(attrs)}
        if self.rules:
            node = len(self.tag)
            for rule in self.rules.matches(tag, given, self.given):
                attribute = self.rules.rules[rule][2]
                self.hits.append((rule, node, given.get(attribute, "") if attribute else None if tag not in VOID else ""))
                if tag in SILENT:
                    self.raw.setdefault(node, [])
        if tag in VOID:
            return
        self.given.append((tag, given))
        self.parent.append(self.open[-1] if self.open else -1)
        self.open.append(len(self.tag))
        self.tag.append(tag)
        self.cls.append(given.get("class") or "")
        self.ident.append(given.get("id") or "")
        self.last.append(0)
        self.t0.append(len(self.texts))
        self.t1.append(0)
        self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.gap |= tag not in INLINE
        depth = self._find(tag)
        if depth is not None:
            self._close(depth)

    def handle_data(self, data):
        if not self.silent:
            self.texts.append(" " + data if self.gap else data)
            self.gap = False
        elif self.open and self.open[-1] in self.raw:
            self.raw[self.open[-1]].append(data)

    def read(self, page):
        self.feed(page or "")
        self.close()
        self._close(0)
        return self

    def row(self):
        # paragraphs before each element and one more, and paragraphs among its children
        pars, kids = [0], [0] * len(self.tag)
        for tag, parent in zip(self.tag, self.parent):
            pars.append(pars[-1] + (tag == "p"))
            if tag == "p" and parent >= 0:
                kids[parent] += 1
        return self.texts, self.tag, self.cls, self.ident, self.parent, self.last, self.t0, self.t1, pars, kids

    def marks(self):
        """What the rules name. Elements to drop count below the containers only, noise counts all the way up; blocks in
        either are left out, and the texts of dropped elements are marked as gone. Containers carry the places of
        their blocks and paragraphs, so that no later step compares elements with each other."""
        span = lambda node: (self.t0[node], self.t1[node]) if node < len(self.tag) else (len(self.texts),) * 2
        found = {}
        for rule, node, value in self.hits:
            kind, n, _, how = self.rules.rules[rule]
            found.setdefault(kind, []).append((n, node, how, value))
        holders = sorted({node for _, node, _, _ in found.get("container", ())})
        ranges = lambda kind: [(node, self.last[node]) for _, node, _, _ in found.get(kind, ()) if node < len(self.tag)]
        dropped = [r for r in ranges("drop") if len(set(between(holders, *r))) == 1]
        size = len(self.tag)
        out = covered(size, dropped + ranges("noise"))
        gone = covered(len(self.texts), [(self.t0[a], self.t1[a] - 1) for a, _ in dropped if self.t1[a] > self.t0[a]])
        own = {node for _, node, _, _ in found.get("own_noise", ())}
        blocks = sorted({node for _, node, _, _ in found.get("block", ()) if not out[node] and node not in own})
        pars = [i for i, tag in enumerate(self.tag) if tag == "p"]
        containers, until = [], {}
        for n, node, _, _ in sorted(x[:2] + (0, 0) for x in found.get("container", ())):
            last = self.last[node]
            nested = node <= until.get(n, -1)
            until[n] = max(until.get(n, -1), last)
            containers.append((n, nested, *span(node), *between(blocks, node + 1, last), *between(pars, node + 1, last)))
        fields = []
        for kind, places in found.items():
            if kind not in ("container", "drop", "noise", "own_noise", "block"):
                for n, node, how, value in sorted(places, key=lambda x: x[:2]):
                    value = "".join(self.raw[node]) if value is None and node in self.raw else value
                    fields.append((kind, n, how, value, *span(node)))
        return self.texts, gone, containers, [span(b) for b in blocks], [span(p) for p in pars], fields


# A batch of pages is read in pieces of so many bytes (or of one page, if it is longer): what Python holds of a batch.
PIECE = 1 << 20


def _pieces(pages):
    """(start, rows) of the pieces of an Arrow column of pages."""
    start = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(pages), 0).to_pylist()):
        if i > start and held + size > PIECE:
            yield start, i - start
            start, held = i, 0
        held += size
    if start < len(pages):
        yield start, len(pages) - start


def _records(rows, fields):
    """Rows of tuples as an Arrow column of structs."""
    return pa.StructArray.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def outline(html):
    """Column of outlines for a column of pages (Arrow batches, one page at a time)."""

    @F.arrow_udf(OUTLINE)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            for start, n in _pieces(pages):
                yield _records([_Reader().read(p).row() for p in pages.slice(start, n).to_pylist()], OUTLINE_FIELDS)

    return read(html)


def marked(html, rules):
    """Column of what the selectors in ``rules`` (an array of kind, n, css, attribute, how) name on each page."""

    @F.arrow_udf(MARKED)
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, given in batches:
            for start, n in _pieces(pages):
                rows = []
                for page, of in zip(pages.slice(start, n).to_pylist(), given.slice(start, n).to_pylist()):
                    compiled = sheet(tuple((r["kind"], r["n"], r["css"], r["attribute"], r["how"]) for r in of))
                    rows.append(_Reader(compiled).read(page).marks())
                yield _records(rows, MARKED_FIELDS)

    return read(html, rules)


LISTED = "seq int, card int, pick int, href string, found array<struct<kind:string,n:int,how:string,text:string>>"


class Listing:
    """Table function: the anchors of a listing page, each with its nearest enclosing block (card) and with what the
    rules find there: (seq, card or -1, pick, href, found). ``pick`` is the anchor's place in its card, by rule first.

    Anchors, cards and fields are ranges of the page's element numbers, so what belongs together is looked up in sorted
    numbers or inherited from the parent. Kinds of rules: ``anchor`` (with @href), ``card``, and fields: the first hit in
    the card, ``<field> own`` below the anchor, ``<field> above`` the nearest enclosing element that fits, ``<field> next``
    the first one behind the anchor."""

    def eval(self, html: str, rules: list):
        reader = _Reader(sheet(tuple((r["kind"], r["n"], r["css"], r["attribute"], r["how"]) for r in rules or ()))).read(html)
        parent, last, size = reader.parent, reader.last, len(reader.tag)
        places, values, kinds = {}, {}, {}
        for rule, node, value in reader.hits:
            places.setdefault(rule, []).append(node)
            values[rule, node] = value
            kinds[rule] = reader.rules.rules[rule]

        def text(rule, node):
            value = values[rule, node]
            return value if value is not None else " ".join("".join(reader.texts[reader.t0[node]:reader.t1[node]]).split())

        def around(nodes):
            """Per element the innermost of ``nodes`` that holds it, itself included; -1 without one."""
            out = []
            for i in range(size):
                out.append(i if i in nodes else out[parent[i]] if parent[i] >= 0 else -1)
            return out

        cards = around({node for rule, kind in kinds.items() if kind[0] == "card" for node in places[rule]})
        above = {rule: around(set(places[rule])) for rule, kind in kinds.items() if kind[0].endswith(" above")}
        links = {}
        for rule, kind in kinds.items():
            if kind[0] == "anchor":
                for node in places[rule]:
                    links[node] = min(links.get(node, (kind[1], rule)), (kind[1], rule))
        order = {}
        for node in sorted(links, key=lambda x: (links[x][0], x)):
            order.setdefault(cards[node], []).append(node)
        pick = {node: i for nodes in order.values() for i, node in enumerate(nodes)}
        for seq, node in enumerate(sorted(links)):
            found = []
            for rule, (kind, n, _, how) in kinds.items():
                name, _, scope = kind.partition(" ")
                if name in ("anchor", "card"):
                    continue
                if scope == "above":
                    at = above[rule][parent[node]] if parent[node] >= 0 else -1
                else:
                    holder = node if scope == "own" or cards[node] < 0 else cards[node]
                    a, b = between(places[rule], last[node] + 1, size) if scope == "next" else between(places[rule], holder, last[holder])
                    at = places[rule][a] if a < b else -1
                if at >= 0:
                    found.append((name, n, how, text(rule, at)))
            yield seq, cards[node], pick[node], values[links[node][1], node], sorted(found)


def listing(html, rules):
    """The rows of ``Listing`` for the page of each row, for use in a lateral join."""
    return F.udtf(Listing, returnType=LISTED, useArrow=True)(html, rules)
