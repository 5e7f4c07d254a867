"""Main-text extraction from web pages by wrapper induction.

The wrapper of a host is a tree of its pages and a region of that tree.  Its
tree is that page, of a bounded sample, which simple tree matching aligns best
with the others.  Every page of the host is then aligned with it, so that each
line of text has a slot, the deepest aligned element around it, and a zone, the
deepest around the line's own element.

What the slots hold is summed over all distinct pages of the host.  A line that
most of them have in one zone is template; the others are content.  The region
is found from the tree's root downwards: into the element that holds the mass of
the content, counted without links, if what stands beside it is no more than
loose lines.  A page's main text are its lines whose slots lie in the region,
without template lines.  Markup that names itself as navigation, adverts and so
on weighs little where the region is found and is left out inside it.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stash

#: Distinct pages of a host that its tree is chosen from, about (an index fitted on a bounded sample).
EXEMPLARS = 8
#: A line is template if so many distinct pages, and this part of those that reach its zone, have it there.
CONSTANT_PAGES, CONSTANT_SHARE = 4, 0.6
#: Template lines stay if they are more than this part of the region's text (copies are not a template).
TEMPLATE_SHARE = 0.3
#: The region goes on into an element that holds at least the first part of the
#: content and, beside other paragraphs, lists and containers, the second.
LEAST_SHARE, REGION_SHARE = 0.1, 0.85
#: Content counts in full, if it is less than this part of all text, template too.
VARYING_SHARE = 0.1
#: Weight of a character in a main heading, in an article or main element, and in markup that names itself as no content.
HEADING, CORE_WEIGHT, NAMED = 8.0, 2.0, 0.1
#: Elements nested deeper are kept at this depth.
MAX_DEPTH = 150
#: Pairs of children that one alignment looks at; longer lists are aligned in memory that grows with their length only.
MAX_CELLS = 40_000
#: Hosts and bytes of wrappers that are broadcast; more are joined by host.
BROADCAST_HOSTS, BROADCAST_BYTES = 50_000, 32 << 20

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
SKIP_TAGS = frozenset("head script style noscript template button select option textarea input iframe object embed svg canvas audio video map applet".split())
NAMED_TAGS = frozenset("nav footer aside form dialog menu".split())
TEXT_TAGS = frozenset("p li dt dd td th tr tbody thead table h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl figure".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "option": {"select"}}
#: Words of class, id and role that name what is not the article.
NOT_CONTENT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "sidebar aside nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead comment comments respond reply replies disqus discussion "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets toolbar copyright complementary contentinfo".split())
#: Words that, beside one of ``LAYOUT``, name a layout and not the part itself.
NEUTRAL = frozenset("with has no without content main article post entry story page wrapper container layout".split())
LAYOUT = frozenset("sidebar menu banner nav header aside widget widgets".split())
CORE = ("article", "main")



class Node:
    """An element, or a run of text (tag ``#text``)."""

    __slots__ = ("tag", "sig", "skip", "named", "kids", "text", "parent", "hints", "size", "n", "last")

    def __init__(self, tag: str, parent: Node | None, sig: str = "", skip: bool = False, named: bool = False, text: str = "", hints: str = ""):
        self.tag, self.parent, self.sig, self.skip, self.named, self.text, self.kids, self.hints = tag, parent, sig or tag, skip, named, text, [], hints
        self.size, self.n, self.last = 0, -1, -1


class Line(NamedTuple):
    """A block's text and where it stands: its element, characters in links,
    whether it is a main heading, in an article or main element, and the
    outermost and innermost elements around it that name themselves."""

    node: Node
    text: str
    links: int
    heading: bool
    core: bool
    outer: Node | None
    inner: Node | None

    @property
    def weight(self) -> float:
        w = float(max(0, len(self.text) - self.links))
        return w * (HEADING if self.heading else 1.0) * (CORE_WEIGHT if self.core else 1.0) * (NAMED if self.outer else 1.0)


def _words(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]


def _names_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    if tag in ("html", "body", *CORE):
        return False
    for name in ("class", "id", "role"):
        for group in attrs.get(name, "").split():
            words = set(_words(group))
            named = words & NOT_CONTENT
            if named and not (named <= LAYOUT and words & NEUTRAL):
                return True
    return False


class _Parser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)
        self.depth = 0

    def _up(self, node: Node) -> None:
        while self.at is not node:
            self.at = self.at.parent
            self.depth -= 1

    def _open(self, tags, scope) -> Node | None:
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                return node
            if node.tag in scope:
                return None
            node = node.parent
        return None

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and (p := self._open({"p"}, {"table", "td", "th", "li", "div", "section", "article", "main", "body", "blockquote"})):
            self._up(p.parent)
        if tag in SIBLINGS:
            while old := self._open(SIBLINGS[tag], SCOPES[tag]):
                self._up(old.parent)
        if tag == "body" and (head := self._open({"head"}, ())):
            self._up(head.parent)
        got = {k: v or "" for k, v in attrs}
        classes = ".".join(sorted(set(re.sub(r"\d+", "", got.get("class", "")).split())))
        role = got.get("role", "")
        hidden = "hidden" in got or got.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", got.get("style", "")))
        named = tag in NAMED_TAGS or _names_boilerplate(tag, got)
        node = Node(tag, self.at, f"{tag}.{classes}" if classes else tag, tag in SKIP_TAGS or hidden and tag not in ("html", "body", *CORE) or named and tag in INLINE, named,
                    hints="main" if role == "main" or got.get("itemprop") == "articleBody" else "")
        if tag == "header" or (tag != "h1" and not node.named and tag in ("div", "section") and {"header"} & set(_words(got.get("class", "") + " " + got.get("id", ""))) and not set(_words(got.get("class", ""))) & NEUTRAL):
            node.hints = "header"
        self.at.kids.append(node)
        if tag not in VOID and self.depth < MAX_DEPTH:
            self.at = node
            self.depth += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag and not self.at.kids:
            self._up(self.at.parent)

    def handle_endtag(self, tag):
        scope = () if tag in ("html", "body") else ("table",) if tag in ("p", "li") else ()
        if node := self._open({tag}, scope):
            self._up(node.parent)

    def handle_data(self, data):
        if data:
            self.at.kids.append(Node("#text", self.at, text=data))

    def unknown_decl(self, data):
        pass


def parse(html: str) -> Node:
    """The tree of a page; markup errors never fail."""
    try:
        p = _Parser()
        p.feed(html)
        p.close()
    except AssertionError:  # a marked section that the parser does not know
        p = _Parser()
        p.feed(html.replace("<![", "&lt;!["))
        p.close()
    _settle(p.root, False)
    return p.root


def _settle(node: Node, inside: bool) -> int:
    """Set sizes (elements below and here); page headers name themselves as no
    content, an article's own header does not if it holds a heading."""
    if node.hints == "header":
        node.named = node.named or not (inside and _has_heading(node))
    node.size = 1 + sum(_settle(k, inside or node.tag in CORE or node.hints == "main") for k in node.kids if k.tag != "#text")
    return node.size


def _has_heading(node: Node) -> bool:
    return any(k.tag in ("h1", "h2") or _has_heading(k) for k in node.kids)


def blocks(root: Node) -> list[Line]:
    """The blocks of a tree in page order: runs of text between starts and ends
    of block elements, white space made single."""
    out: list[Line] = []
    run: list[str] = []
    state = {"node": root, "links": 0, "heading": False, "core": False, "outer": None, "inner": None}

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                out.append(Line(text=text, **state))
        state["links"] = 0

    def walk(n: Node, link: bool) -> None:
        for k in n.kids:
            if k.tag == "#text":
                run.append(k.text)
                if link:
                    state["links"] += len(" ".join(k.text.split()))
            elif k.tag == "br":
                run.append(" ")
            elif k.skip:
                if k.tag not in INLINE:
                    flush()
            elif k.tag in INLINE:
                walk(k, link or k.tag == "a")
            else:
                flush()
                before = dict(state)
                state.update(node=k, heading=state["heading"] or k.tag == "h1", core=state["core"] or k.tag in CORE or k.hints == "main")
                if k.named:
                    state.update(outer=state["outer"] or k, inner=k)
                walk(k, link)
                flush()
                state.update(before, links=0)

    walk(root, False)
    flush()
    return out


def elements(node: Node) -> list[Node]:
    return [k for k in node.kids if k.tag != "#text" and not k.skip and k.tag not in INLINE]


def number(root: Node) -> list[Node]:
    """The elements of a tree from the root on; each gets its place ``n`` there
    and that of the last one inside it."""
    out: list[Node] = []

    def walk(n: Node) -> None:
        n.n = len(out)
        out.append(n)
        for k in elements(n):
            walk(k)
        n.last = len(out) - 1

    walk(root)
    return out


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None) -> int:
    """Simple tree matching: the most pairs of nodes of equal signature that
    keep order and ancestry; ``pairs`` gets one such set.

    Children are aligned by dynamic programming over the sizes of their best
    matchings.  Lists whose product exceeds ``MAX_CELLS`` are aligned as well as
    others, by :func:`align`.
    """
    if a.sig != b.sig:
        return 0
    xs, ys = elements(a), elements(b)
    if pairs is not None:
        pairs.append((a, b))
    if not xs or not ys:
        return 1
    if len(xs) * len(ys) > MAX_CELLS:
        total, found = align(xs, ys)
        if pairs is not None:
            for i, j in found:
                match(xs[i], ys[j], pairs)
        return 1 + total
    w = [[(min(x.size, y.size) if not x.kids or not y.kids or max(x.size, y.size) == 1 else match(x, y)) if x.sig == y.sig else 0 for y in ys] for x in xs]
    m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs)):
        for j in range(len(ys)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + w[i][j])
    if pairs is not None:
        i, j, found = len(xs), len(ys), []
        while i and j:
            if m[i][j] == m[i - 1][j]:
                i -= 1
            elif m[i][j] == m[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((i, j))
        for i, j in reversed(found):
            match(xs[i], ys[j], pairs)
    return 1 + m[len(xs)][len(ys)]


def align(xs: list[Node], ys: list[Node]) -> tuple[int, list[tuple[int, int]]]:
    """(size, index pairs) of a best alignment of two lists of elements, by
    Hirschberg's halving: rows of the table only, and one matching for each two
    shapes."""
    import numpy as np

    shapes: dict = {}

    def shape(n: Node) -> int:
        return shapes.setdefault((n.sig, n.size, bool(n.kids), tuple(shape(k) for k in elements(n))), len(shapes))

    sx, sy = [shape(x) for x in xs], [shape(y) for y in ys]
    kinds, code = np.unique(sy, return_inverse=True)
    example = {k: ys[sy.index(k)] for k in kinds.tolist()}
    weights: dict = {}

    def weight(x: Node, y: Node) -> int:
        if x.sig != y.sig:
            return 0
        return min(x.size, y.size) if not x.kids or not y.kids or max(x.size, y.size) == 1 else match(x, y)

    for x, k in zip(xs, sx):
        if k not in weights:
            weights[k] = np.array([weight(x, example[y]) for y in kinds.tolist()], np.int64)

    def last(rows, columns):
        """The last row of the table."""
        row = np.zeros(len(columns) + 1, np.int64)
        for k in rows:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights[k][columns]))
        return row

    found, todo = [], [(0, len(xs), 0, len(ys))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a == 1:
            w = weights[sx[a]][code[c:d]]
            if w.max() > 0:
                found.append((a, c + int(w.argmax())))
            continue
        m = (a + b) // 2
        cut = c + int((last(sx[a:m], code[c:d]) + last(sx[m:b][::-1], code[c:d][::-1])[::-1]).argmax())
        todo += [(a, m, c, cut), (m, b, cut, d)]
    found.sort()
    return sum(int(weights[sx[i]][code[j]]) for i, j in found), found


class Spot(NamedTuple):
    """Where a line stands in the tree that its page is aligned with (-1 if
    there is none): ``outer`` and ``inner`` are twice the number of the
    self-named elements around it, or one more than that of the element that
    they are in if they are not aligned themselves."""

    slot: int
    zone: int
    outer: int
    inner: int
    own: bool
    heading: bool
    share: int
    text: str


def read(html: str, tree: Node | None) -> list[Spot]:
    """The lines of a page, aligned with a tree.  ``own`` marks those in the
    page's own region, ``share`` is a line's part of the content in millionths."""
    root = parse(html)
    lines = blocks(root)
    if not lines:
        return []
    place: dict[int, int] = {}
    if tree is not None:
        pairs: list[tuple[Node, Node]] = []
        match(tree, root, pairs)
        place = {id(y): x.n for x, y in pairs}

    def slot(n: Node | None) -> int:
        while n is not None:
            if id(n) in place:
                return place[id(n)]
            n = n.parent
        return -1

    def named(n: Node | None) -> int:
        return -1 if n is None else 2 * place[id(n)] if id(n) in place else 2 * slot(n.parent) + 1

    nodes = number(root)
    known = {id(n) for n in nodes}
    mine = []
    for line in lines:
        n = line.node
        while id(n) not in known:
            n = n.parent
        mine.append(n.n)
    own = Region.of(nodes, _sums((n, line.weight) for n, line in zip(mine, lines) if not line.heading), _sums((n, line.weight) for n, line in zip(mine, lines) if line.heading))
    whole = sum(line.weight for line in lines) or 1.0
    out = []
    for line, at in zip(lines, mine):
        inside = own.low <= at <= own.high and (line.outer is None or not any(own.low < n.n <= own.high or n.n < 0 for n in (line.outer, line.inner)))
        out.append(Spot(slot(line.node), slot(line.node.parent or line.node), named(line.outer), named(line.inner), inside, line.heading and line.outer is None, round(1e6 * line.weight / whole), line.text))
    return out


def _sums(pairs: Iterable[tuple[int, float]]) -> dict[int, float]:
    out: dict[int, float] = {}
    for n, w in pairs:
        out[n] = out.get(n, 0.0) + w
    return out


class Region(NamedTuple):
    """The elements from ``low`` to ``high`` of a tree."""

    low: int
    high: int

    @classmethod
    def of(cls, nodes: list[Node], mass: dict[int, float], heads: dict[int, float]) -> Region:
        """The region of a numbered tree, from the mass of content in each
        element itself.  Main headings help to find the way, but content alone
        decides whether an element stands for all of its parent."""
        sums = []
        for each in (mass, heads):
            total = [0.0]
            for n in range(len(nodes)):
                total.append(total[-1] + each.get(n, 0.0))
            sums.append(total)
        within = lambda n: sums[0][n.last + 1] - sums[0][n.n]
        headed = lambda n: within(n) + sums[1][n.last + 1] - sums[1][n.n]
        # a container has blocks of its own below; the others are lines
        container = lambda n: n.tag not in TEXT_TAGS and any(headed(k) > 0 for k in elements(n))
        at = nodes[0]
        while kids := [k for k in elements(at) if container(k)]:
            best = max(kids, key=headed)
            beside = sum(within(k) for k in elements(at) if k is not best and not k.named and (k.tag in TEXT_TAGS or container(k)))
            if headed(best) < LEAST_SHARE * headed(at) or within(best) < REGION_SHARE * (within(best) + beside):
                break
            at = best
        lone = [k for k in elements(at) if headed(k) > 0 and k.tag not in TEXT_TAGS]
        if at.tag in ("#root", "html", "body") and len(lone) == 1 and not container(lone[0]) and within(lone[0]) >= REGION_SHARE * within(at):
            at = lone[0]  # a page of one plain element
        return cls(at.n, at.last)


def pack(root: Node) -> str:
    """The tree's elements as JSON."""
    def walk(n: Node):
        return [n.sig, int(n.named), [walk(k) for k in elements(n)]]

    return json.dumps(walk(root), ensure_ascii=False, separators=(",", ":"))


def unpack(tree: str) -> Node:
    def walk(item, parent: Node | None) -> Node:
        sig, named, kids = item
        node = Node(sig.split(".", 1)[0], parent, sig, named=bool(named))
        node.kids = [walk(k, node) for k in kids]
        node.size = 1 + sum(k.size for k in node.kids)
        return node

    root = walk(json.loads(tree), None)
    number(root)
    return root


def choose_tree(pages: list[str]) -> Node:
    """That page of a few whose tree matches the others best, relative to their sizes."""
    roots = [unpack(pack(parse(p))) for p in pages]
    if len(roots) == 1:
        return roots[0]
    score = [0.0] * len(roots)
    for i, a in enumerate(roots):
        for j in range(i):
            m = 2 * match(a, roots[j]) / (a.size + roots[j].size)
            score[i] += m
            score[j] += m
    return roots[max(range(len(roots)), key=lambda i: (score[i], -i))]


def decide(tree: Node, mass: dict[int, tuple[float, float, float]]) -> dict:
    """The wrapper's region from (all content, content that is no template,
    mass of main headings that are none) of each slot.

    ``drop`` tells whether template lines are left out, ``heads`` whether main
    headings before the region belong to the text, as there are none inside.
    """
    nodes = number(tree)
    every = {n: m[0] for n, m in mass.items()}
    varying = {n: m[1] for n, m in mass.items()}
    region = Region.of(nodes, varying if sum(varying.values()) >= VARYING_SHARE * sum(every.values()) else every, {n: m[2] for n, m in mass.items()})
    inside = [n for n in mass if region.low <= n <= region.high]
    text = sum(every[n] for n in inside)
    fixed = text - sum(varying[n] for n in inside)
    heads = not any(mass[n][2] for n in inside) and any(m[2] for n, m in mass.items() if n < region.low)
    return {"low": region.low, "high": region.high, "drop": fixed <= TEMPLATE_SHARE * text, "heads": heads}


def induce(pages: list[str]) -> dict:
    """The wrapper of a few distinct pages, as :func:`main_text` finds that of
    all pages of a host."""
    tree = choose_tree(pages[:EXEMPLARS])
    read_pages = [read(p, tree) for p in pages]
    have = Counter(x for spots in read_pages for x in {(s.zone, s.text) for s in spots})
    reach = Counter(z for spots in read_pages for z in {s.zone for s in spots})
    constants = {x for x, n in have.items() if n >= CONSTANT_PAGES and n >= CONSTANT_SHARE * reach[x[0]]}
    mass: dict[int, tuple[float, float, float]] = {}
    for s in (s for spots in read_pages for s in spots):
        a, b, c = mass.get(s.slot, (0.0, 0.0, 0.0))
        new = (s.zone, s.text) not in constants
        mass[s.slot] = (a, b, c + s.share * new) if s.heading else (a + s.share, b + s.share * new, c)
    found = decide(tree, mass)
    return {**found, "tree": pack(tree), "constants": sorted(constants) if found["drop"] else []}


def extract(html: str, wrapper: dict | None = None) -> str:
    """The main text of a page, through its host's wrapper if it fits.

    A page that has nothing in the wrapper's region is read through its own.
    """
    spots = read(html, unpack(wrapper["tree"]) if wrapper else None)
    kept = []
    if wrapper:
        low, high, constants = wrapper["low"], wrapper["high"], {tuple(c) for c in wrapper["constants"]}
        inside = lambda n: 2 * low < n <= 2 * high + 1
        kept = [s for s in spots if (low <= s.slot <= high and not inside(s.outer) and not inside(s.inner) or wrapper["heads"] and s.heading and s.slot < low) and (s.zone, s.text) not in constants]
        if not any(s.slot >= low for s in kept):
            kept = []
    return " ".join(s.text for s in kept or [s for s in spots if s.own])


def host_of(url):
    """The host of a URL column, lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def induce_trees(pages: DataFrame) -> DataFrame:
    """(host, tree) from (host, html, d), d the page's digest: about
    ``EXEMPLARS`` distinct pages of each host, one at least, are aligned in one
    task.  The sample is by hash of the page against a rate from the host's
    exact number of distinct pages, so a host with a third of all pages sends no
    more than any other."""
    many = stash(pages.select("host", "d").distinct().groupBy("host").agg(F.count("*").alias("count"), F.min("d").alias("first")), "hosts")
    hosts = F.broadcast(many) if many.count() <= BROADCAST_HOSTS else many
    u = F.pmod(F.xxhash64("d", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = pages.join(hosts, "host").where((u * F.col("count") < EXEMPLARS) | (F.col("d") == F.col("first"))).groupBy("host", "d").agg(F.first("html").alias("html"))

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("d")
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "tree": [pack(choose_tree(pdf["html"].tolist()))]})

    return some.select("host", "d", "html").groupBy("host").applyInPandas(run, "host string, tree string")


def small(table: DataFrame, *columns: str) -> DataFrame:
    """A table by host, to be broadcast if it is small enough."""
    size = table.agg(F.count("*").alias("n"), *[F.sum(F.octet_length(c)).alias(c) for c in columns]).first()
    return F.broadcast(table) if size["n"] <= BROADCAST_HOSTS and sum(size[c] or 0 for c in columns) <= BROADCAST_BYTES else table


SPOTS = "array<struct<slot:int,zone:int,outer:int,inner:int,own:boolean,heading:boolean,share:int,text:string>>"


def align_pages(rows: DataFrame) -> DataFrame:
    """(page_id, url, host, d, spots) from (page_id, url, host, d, html, tree)."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        loaded: dict = {None: None}
        kinds = [pa.int32()] * 4 + [pa.bool_()] * 2 + [pa.int32(), pa.string()]
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                found, ends = [], [0]
                for page, tree in zip(part.column(4).to_pylist(), part.column(5).to_pylist()):
                    if tree not in loaded:
                        if len(loaded) > 500:
                            loaded = {None: None}
                        loaded[tree] = unpack(tree)
                    found += read(page, loaded[tree])
                    ends.append(len(found))
                fields = [pa.array(list(c), k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
                spots = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, list(Spot._fields)))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], spots], ["page_id", "url", "host", "d", "spots"])

    return rows.select("page_id", "url", "host", "d", "html", "tree").mapInArrow(run, f"page_id long, url string, host string, d string, spots {SPOTS}")


def wrappers(read_pages: DataFrame, trees: DataFrame) -> DataFrame:
    """(host, low, high, drop, heads, constants) from all distinct pages of
    each host; ``constants`` are hashes of (zone, text)."""
    line = F.transform("spots", lambda s: F.struct(s["slot"].alias("slot"), s["zone"].alias("zone"), s["share"].alias("share"), s["heading"].alias("heading"), _line_hash(s).alias("h")))
    # copies of a page count once
    distinct = stash(read_pages.where("host != ''").select("host", "d", line.alias("lines")).dropDuplicates(["host", "d"]), "lines")
    here = distinct.select("host", F.explode(F.array_distinct(F.transform("lines", lambda s: F.struct(s["zone"].alias("zone"), s["h"].alias("h"))))).alias("x"))
    often = here.groupBy("host", "x.zone", "x.h").count().where(F.col("count") >= CONSTANT_PAGES)
    reach = distinct.select("host", F.explode(F.array_distinct("lines.zone")).alias("zone")).groupBy("host", "zone").agg(F.count("*").alias("pages"))
    constant = stash(often.join(reach, ["host", "zone"]).where(F.col("count") >= F.lit(CONSTANT_SHARE) * F.col("pages")).select("host", "h"), "constants")
    lines = distinct.select("host", F.explode("lines").alias("x")).select("host", "x.*").join(constant.withColumn("fixed", F.lit(True)), ["host", "h"], "left")
    new = F.col("fixed").isNull()
    mass = lines.groupBy("host", "slot").agg(
        *[F.sum(F.when(c, F.col("share")).otherwise(0)).alias(name) for name, c in (("every", ~F.col("heading")), ("varying", new & ~F.col("heading")), ("heads", new & F.col("heading")))])
    # at most one row for each element of the host's tree
    mass = mass.groupBy("host").agg(F.collect_list(F.struct("slot", "every", "varying", "heads")).alias("mass"))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for host, tree, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = decide(unpack(tree), {r["slot"]: (r["every"], r["varying"], r["heads"]) for r in rows})
                out.append((host, found["low"], found["high"], found["drop"], found["heads"]))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["host", "low", "high", "drop", "heads"])

    regions = trees.join(mass, "host").select("host", "tree", "mass").mapInArrow(run, "host string, low int, high int, drop boolean, heads boolean")
    # each of them is on most of the pages that reach its zone, so they are no more than about one page's lines
    lists = constant.groupBy("host").agg(F.collect_set("h").alias("constants"))
    return regions.join(lists, "host", "left").select("host", "low", "high", "drop", "heads", F.when(F.col("drop"), F.col("constants")).alias("constants"))


def _line_hash(s):
    return F.xxhash64(s["zone"], s["text"])


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null page is empty and has an empty text.  Pages without a host, and
    those with nothing in their host's region, are read through their own.
    Character references are decoded, white space (as Python splits it) inside a
    block is one space, blocks are joined by a space in page order.  Repeated
    rows and null keys stay; copies of a page count once for its host; other
    columns are not read; an empty table gives an empty result.
    """
    page = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), page.alias("html"), host_of(F.col(url)).alias("host")).withColumn("d", F.md5("html"))
    trees = stash(induce_trees(rows.where("host != '' AND html != ''").select("host", "html", "d")), "trees")
    got = stash(align_pages(rows.join(small(trees, "tree"), "host", "left")), "aligned")
    found = stash(wrappers(got, trees), "wrappers")
    count = found.agg(F.count("*").alias("n"), F.sum(F.size("constants")).alias("c")).first()
    if count["n"] <= BROADCAST_HOSTS and 8 * (count["c"] or 0) <= BROADCAST_BYTES:
        found = F.broadcast(found)
    both = got.join(found, "host", "left")

    def kept(s):
        low, high = F.col("low"), F.col("high")
        inside = lambda n: (n > 2 * low) & (n <= 2 * high + 1)
        here = (s["slot"] >= low) & (s["slot"] <= high) & ~inside(s["outer"]) & ~inside(s["inner"])
        head = F.col("heads") & s["heading"] & (s["slot"] < low)
        fixed = F.coalesce(F.array_contains("constants", _line_hash(s)), F.lit(False))
        return F.coalesce((here | head) & ~fixed, F.lit(False))

    spots = both.select("page_id", "url", "low", "spots", F.filter("spots", kept).alias("kept"))
    fits = F.exists("kept", lambda s: s["slot"] >= F.col("low"))
    text = F.concat_ws(" ", F.transform(F.when(fits, F.col("kept")).otherwise(F.filter("spots", lambda s: s["own"])), lambda s: s["text"]))
    return spots.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
