"""Main text of web pages by composite text density (Sun, Song and Liao, 2011).

Every node of a page has a density: its characters per tag, adjusted by how many of them are links. A node's density sum
adds the densities of its children. The node of largest sum is content; the least density on its path up to the body is
the threshold; in every other branch at least as dense, the node of largest sum in that branch is content too.

Nodes whose name, role, class or id says that they are no article text (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments) are taken out before densities are computed. Content inside an
``article`` stands for that whole element. A ``main`` element bounds the search: what lies outside is no content, inside
densities decide, and headings without links stay. Markup that cannot be read is passed over as browsers do; no page fails.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.llm.frames import column

# Element names and hints of markup.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title svg math iframe object applet canvas audio video map select textarea datalist".split())
APART = frozenset("nav footer aside form button menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside widget widgets header masthead topbar "
    "footer footnav copyright cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
    "signup login comment comments reply replies respond disqus social share sharing related recommended toolbar".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag ends: open elements of these names, up to the nearest of those that hold them.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: How a declaration begins, and what belongs to it; the first that fits counts.
DECLARATIONS = [
    ("<!--", re.compile("<!--(?:-?>|.*?--!?>)", re.S)), ("<!doctype", re.compile(r"<!doctype[^>\[]*(?:\[.*?\]\s*)?>", re.S | re.I)), ("<!", re.compile("<![^>]*>")),
]
#: A tag that the page ends within.
UNENDED = re.compile(r"</?[a-zA-Z][^<>]*\Z")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Node:
    """``apart``: no article text, 1 by its element or 2 by a hint only."""

    __slots__ = ("tag", "parent", "parts", "apart", "chars", "tags", "link_chars", "link_tags", "density", "total", "best", "content")

    def __init__(self, tag: str, parent: Node | None, apart: int):
        self.tag, self.parent, self.parts, self.apart, self.content = tag, parent, [], apart, False


def _hinted(attrs: list[tuple[str, str | None]], hints: frozenset) -> bool:
    for name, value in attrs:
        if not value:
            continue
        if name == "role" and value.strip().lower() in ROLES:
            return True
        if name in ("class", "id") and not hints.isdisjoint(p.lower() for p in SPLIT.split(value)):
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


class Page(HTMLParser):
    """Builds the tree of a page; whatever is not closed ends with what holds it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.node = Node("body", None, 0)
        self.open: dict[str, int] = {}

    def _up_to(self, node: Node) -> None:
        while self.node is not node:
            self.open[self.node.tag] -= 1
            self.node = self.node.parent

    def _end(self, names, holders) -> None:
        if not any(self.open.get(n) for n in names):
            return
        node = self.node
        while node is not self.root and node.tag not in holders:
            if node.tag in names:
                self._up_to(node.parent)
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self._end(("p",), ("table", "td", "th", "button", "object"))
        if tag in ENDS:
            self._end(*ENDS[tag])
        within = self.open.get("article") or self.open.get("main")
        hard = tag in HIDDEN or tag in APART or tag == "header" and not within
        if tag in ("article", "main"):  # a hint on what holds the article is none
            node = self.node
            while node is not None:
                node.apart &= 1
                node = node.parent
            node = Node(tag, self.node, 0)
        else:
            node = Node(tag, self.node, 1 if hard else 2 * _hinted(attrs, HINTS - {"header"} if within else HINTS))
        self.node.parts.append(node)
        if tag not in VOID:
            self.open[tag] = self.open.get(tag, 0) + 1
            self.node = node

    def unhint(self) -> None:
        """Lets hinted nodes count: without them the page has no text."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            node.apart &= 1
            todo += [c for c in node.parts if isinstance(c, Node)]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # a slash closes foreign elements only; elsewhere browsers read it as an opening tag
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open.get(tag):
            node = self.node
            while node.tag != tag:
                node = node.parent
            self._up_to(node.parent)

    def handle_data(self, data):
        self.node.parts.append(data)

    def parse_html_declaration(self, i, report=True):
        """Past a comment, a document type with its subset, or any other ``<!`` up to the next ``>``; past the rest if it never ends."""
        kind = next(pattern for start, pattern in DECLARATIONS if self.rawdata[i : i + len(start)].lower() == start)
        found = kind.match(self.rawdata, i)
        return found.end() if found else len(self.rawdata)

    parse_comment = parse_html_declaration

    def parse_pi(self, i):
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)


def _measure(root: Node) -> int:
    """Counts of every node that is not apart, then densities and sums; gives the number of characters."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.parts if isinstance(c, Node) and not c.apart]
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for c in node.parts:
            if not isinstance(c, Node):
                node.chars += len(c.strip())
            elif not c.apart:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.chars if c.tag == "a" else c.link_chars
                node.link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in reversed(order):
        c, t, lt = node.chars, max(node.tags, 1), max(node.link_tags, 1)
        node.density = 0.0
        if c:
            lc = max(node.link_chars, 1)
            base = math.log(c / max(c - node.link_chars, 1) * lc + share * c + math.e)
            node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(base)
        node.total, node.best = 0.0, node
        for child in node.parts:
            if isinstance(child, Node) and not child.apart:
                node.total += child.density
        if not any(isinstance(x, Node) and not x.apart for x in node.parts):
            node.total = node.density  # text alone
        for child in node.parts:
            if isinstance(child, Node) and not child.apart and child.best.total > node.best.total:
                node.best = child.best
    return root.chars


def _bound(root: Node) -> Node:
    """The page's only ``main`` element that has text, or the page."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "main" and node.chars:
            found.append(node)
        else:
            todo += [c for c in node.parts if isinstance(c, Node) and not c.apart]
    return found[0] if len(found) == 1 else root


def _mark(root: Node) -> None:
    bound = _bound(root)
    limit, node = bound.density, bound.best
    while node is not bound:
        limit = min(limit, node.density)
        node = node.parent
    todo = [bound]
    while todo:
        node = todo.pop()
        if bound is not root and node.tag in HEADINGS and not node.link_chars:
            node.content = True
        if node.density >= limit and node.chars:
            chosen = holder = node.best
            while holder is not None:
                if holder.tag == "article":
                    chosen = holder
                holder = holder.parent
            chosen.content = True
            todo += [c for c in node.parts if isinstance(c, Node) and not c.apart]
        elif bound is not root:
            todo += [c for c in node.parts if isinstance(c, Node) and not c.apart and c.tag in HEADINGS]


def main_text(html: str | None) -> str:
    """The article of a page: blocks in page order joined by line feeds, white space in a block turned into one space."""
    if not html:
        return ""
    page = Page()
    page.feed(UNENDED.sub("", html))
    page.close()
    if not _measure(page.root):
        page.unhint()
        if not _measure(page.root):
            return ""
    _mark(page.root)
    blocks: list[str] = []
    piece: list[str] = []

    def finish():
        text = " ".join("".join(piece).split())
        if text:
            blocks.append(text)
        piece.clear()

    todo: list = [(page.root, page.root.content)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            finish()
        elif isinstance(item, str):
            if inside:
                piece.append(item)
        elif not item.apart:
            inside = inside or item.content
            block = item.tag in BLOCKS
            if block:
                finish()
                todo.append((None, inside))
            elif item.tag == "br":
                todo.append((" ", inside))
            todo += [(part, inside) for part in reversed(item.parts)]
    finish()
    return "\n".join(blocks)


def extract(pages: DataFrame, html_col: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole html in ``to``, which is replaced if there is one.

    Null, empty and text-free pages give an empty text. Pages are independent: no shuffle, one page in memory at a time
    beside its batch; repeated rows give equal texts and an empty table an empty result.
    """

    @F.pandas_udf(T.StringType())
    def texts(html: pd.Series) -> pd.Series:
        return html.map(main_text, na_action=None)

    return pages.withColumn(to, texts(F.coalesce(column(html_col), F.lit(""))))
