"""Main text of web pages by composite text density.

Every element of a page gets its link-adjusted number of characters per tag; the densities
of the children of an element add up to its density sum. The element with the largest sum
is the main part of the page; the smallest density on its path to the body is the least
that a neighbour on that path needs to belong to it. Menus, headers, footers, adverts,
forms, scripts, notices and reader comments neither count nor enter the text.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# fixed values: elements of the markup language by their part in a page
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
OUT = {
    "head", "script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "template", "nav", "footer",
    "aside", "form", "button", "select", "option", "label", "fieldset", "dialog", "menu", "svg", "canvas", "object", "audio", "video",
}
BLOCK = {
    "html", "body", "address", "article", "blockquote", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "li", "main", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# an element of the key ends open ones of the value, up to the nearest container
CELLS = {"td", "th"}
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": CELLS, "th": CELLS, "tr": CELLS | {"tr"},
    "tbody": CELLS | {"tr", "thead", "tbody"}, "tfoot": CELLS | {"tr", "tbody"}, "body": {"head"},
}
HOLDS = {"ul", "ol", "dl", "table", "div", "article", "main", "section", "body"}
# words in class, id and role that name a part which is not the article
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "dialog", "disqus", "footer", "gdpr", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo",
    "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget",
}
# the same for an article, which is the page's own unless it is a reader's
COMMENTS = {"comment", "comments", "reply", "promo", "sponsored"}
WHOLE = {"html", "body", "main"}
NAMING = {"class", "id", "role", "hidden", "aria-hidden"}


class Node:
    """One element: its place in the page and what stands inside it."""

    __slots__ = ("tag", "parent", "out", "end", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: int, out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.end = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _marked(tag: str, attributes: str) -> bool:
    """Whether class, id or role name a part that is not the article, or the element is hidden."""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name not in NAMING:
            continue
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        words = set(re.split(r"[^a-z0-9]+", CAMEL.sub(" ", value).lower()))
        if words & (COMMENTS if tag == "article" else MARKS) and tag not in WHOLE:
            return True
    return False


class Page:
    """Elements in page order and the blocks of text they hold."""

    def __init__(self, source: str):
        self.nodes = [Node("", -1, False)]
        self.blocks: list[tuple[int, str]] = []
        self.open = [0]
        self.text: list[str] = []
        self.linked: list[str] = []
        self.link = -1
        self._read(source)
        self._flush()
        while len(self.open) > 1:
            self._close(len(self.open) - 1)
        self.nodes[0].end = len(self.nodes)
        self._measure()

    def _flush(self) -> None:
        if self.text:
            block = " ".join("".join(self.text).split())
            self.text = []
            if block:
                at = self.open[-1]
                self.blocks.append((at, block))
                node = self.nodes[at]
                node.chars += len(block)
                node.link_chars += min(len(block), len(" ".join("".join(self.linked).split())))
            self.linked = []

    def _add(self, raw: str) -> None:
        if raw and not self.nodes[self.open[-1]].out:
            text = html.unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if self.link >= 0:
                self.linked.append(text)

    def _close(self, depth: int) -> None:
        """End the open elements from ``depth`` on."""
        self._flush()
        for at in reversed(self.open[depth:]):
            self.nodes[at].end = len(self.nodes)
            if self.link >= at:
                self.link = -1
        del self.open[depth:]

    def _end(self, tag: str, among: set[str]) -> None:
        """End the nearest open element of ``among``, unless a container stands between."""
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.nodes[self.open[depth]].tag
            if name in among:
                return self._close(depth)
            if name in HOLDS:
                return None
        return None

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ENDS:
            while len(self.open) > 1 and self.nodes[self.open[-1]].tag in ENDS[tag]:
                self._close(len(self.open) - 1)
            self._end(tag, ENDS[tag])
        if tag in BLOCK:
            self._end(tag, {"p", *HEADINGS} if tag in HEADINGS else {"p"})
        parent = self.nodes[self.open[-1]]
        inside = any(self.nodes[at].tag == "article" for at in self.open) if tag == "header" else False
        out = parent.out or tag in OUT or (tag == "header" and not inside) or (bool(attributes) and _marked(tag, attributes))
        if tag in BLOCK or (out and not parent.out and tag not in VOID):
            self._flush()
            self.nodes.append(Node(tag, self.open[-1], out))
            self.open.append(len(self.nodes) - 1)
        elif out:
            return
        else:
            parent.tags += 1
            if tag == "br":
                self.text.append(" ")
            elif tag == "hr":
                self._flush()
            elif tag == "a":
                parent.link_tags += 1
                self.link = self.open[-1]

    def _finish(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[depth]].tag == tag:
                return self._close(depth)
            # an end tag inside a part that is left out cannot end what holds that part, unless that is a block
            if tag not in BLOCK and self.nodes[self.open[depth]].tag in BLOCK:
                break
        if tag == "a":
            self.link = -1
        return None

    def _read(self, source: str) -> None:
        at, lower = 0, None
        while found := TOKEN.search(source, at):
            self._add(source[at : found.start()])
            at = found.end()
            closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._finish(tag)
                continue
            self._start(tag, attributes)
            if tag in RAW:
                lower = lower or source.lower()
                at = lower.find(f"</{tag}", at)
                at = len(source) if at < 0 else at
        # a tag that the page breaks off is no text
        self._add(source[at:])

    def _measure(self) -> None:
        """Totals of every subtree, densities, density sums."""
        nodes = self.nodes
        own = [(n.chars, n.link_chars) for n in nodes]
        for n in reversed(nodes[1:]):
            if not n.out:
                up = nodes[n.parent]
                up.chars, up.tags = up.chars + n.chars, up.tags + n.tags + 1
                up.link_chars, up.link_tags = up.link_chars + n.link_chars, up.link_tags + n.link_tags
        page = nodes[0]
        share = page.link_chars / max(page.chars, 1)
        for n in nodes:
            if not n.out:
                n.density = density(n.chars, n.tags, n.link_chars, n.link_tags, share)
        for n, (chars, linked) in zip(nodes, own, strict=True):
            if not n.out:
                n.total += density(chars, 1, linked, 1 if linked else 0, share)
                if n.parent >= 0:
                    nodes[n.parent].total += n.density

    def _path(self, at: int) -> list[int]:
        """From an element up to the body, or to the page where there is none."""
        path = [at]
        while path[-1] and self.nodes[path[-1]].tag != "body":
            path.append(self.nodes[path[-1]].parent)
        return path

    def main_text(self) -> str:
        nodes = self.nodes
        inside = [False] * len(nodes)
        for i, n in enumerate(nodes):
            inside[i] = not n.out and (n.tag in ("article", "main") or (i > 0 and inside[n.parent]))
        chosen = [i for i, n in enumerate(nodes) if inside[i] and n.chars] or [i for i, n in enumerate(nodes) if not n.out]
        best = max(chosen, key=lambda i: (nodes[i].total, -i))
        path = self._path(best)
        marked = [i for i in path if nodes[i].tag == "article"] or [i for i in path if nodes[i].tag == "main"]
        if marked:
            spans = [(marked[-1], nodes[marked[-1]].end)]
        else:
            least = min(nodes[i].density for i in path)
            spans = [(best, nodes[best].end)]
            for child, up in zip(path, path[1:], strict=False):
                for i in range(up + 1, nodes[up].end):
                    n = nodes[i]
                    if n.parent == up and i != child and not n.out:
                        if n.density >= least or (n.tag in HEADINGS and i < child):
                            spans.append((i, n.end))
                # text that stands directly in an element of the path
                spans.append((up, up + 1))
        keep = bytearray(len(nodes))
        for a, b in spans:
            keep[a:b] = b"\x01" * (b - a)
        for i, n in enumerate(nodes):
            # a list of nothing but links is a menu
            if keep[i] and n.tag in ("ul", "ol") and n.link_tags > 1 and n.link_chars == n.chars:
                keep[i : n.end] = bytes(n.end - i)
        return " ".join(text for i, text in self.blocks if keep[i])


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_share: float) -> float:
    """Characters per tag, less where links hold many of the characters.

    C / T * log(C / LC * T / LT) to the base ln(C / (C - LC) * LC + share * C + e), zero counts as
    one; the base is at least 2, which a page without links would otherwise miss.
    """
    if not chars:
        return 0.0
    tags = max(tags, 1)
    plain = max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + page_share * chars + math.e)
    ratio = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    return chars / tags * math.log(max(ratio, 1.0)) / math.log(max(base, 2.0))


def main_text(source: str | None) -> str:
    """Article of one page, blocks joined by one space; empty for a null, empty or textless page."""
    return Page(source).main_text() if source else ""


def _texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(x.as_py()) for x in pages], pa.string())


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each; a column named like the new one is replaced.

    Pages are read whole, of any length. Null, empty and textless pages give the empty string; a
    page without any element is one block. Equal pages give equal texts. An empty table
    stays empty.
    """
    text = F.arrow_udf(_texts, "string")(F.col(html_col))
    return pages.withColumn(text_col, text)
