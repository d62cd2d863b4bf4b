"""Main text of web pages by tree scoring.

A small tolerant parser builds the element tree of a page. Boilerplate
elements are set aside; every paragraph then gives points for its length and
its commas to its ancestors (all of them to the parent, half to the next, a
third to the one above), each container's sum is discounted by its link density,
and the best container is kept with those siblings that score close to it or
read like text; an article or main around it takes its place, and an article
in main is kept with such siblings on every level up to main. Text blocks come out in page order.

Defined results: null or empty html gives empty text; a page without
paragraphs falls back to loose text in its body; repeated rows are repeated;
ties between containers go to the first in the page. Unclosed and stray tags are
tolerated; nothing is cut off. Extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_blocks, string_column, utf8_parts

_MARK = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_PLAIN = re.compile(r"""[^>"']*+""")
_ATTR = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|\b(hidden)\b""")
_RAW = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split())
_CLOSES_P = _BLOCK - {"br", "option", "caption", "html", "body"}
_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOP = frozenset("table ul ol dl article section div body html main aside nav form".split())
_DROP = frozenset("nav footer aside form button select menu dialog head svg canvas object audio video map datalist".split())
_PARAGRAPH = frozenset("p pre blockquote li td dd".split())
_SECTION = ("article", "main")
#: Words in class, id or role that mark boilerplate.
_BAD = frozenset(
    "ad ads adbox adslot adunit adsbygoogle adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner sidebar sidenav aside teaser menu submenu mainmenu nav navbar subnav topnav topbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments commentlist discussion disqus reply replies respond cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "widget toolbar pagination pager skip copyright search contentinfo complementary dialog tooltip outbrain taboola".split())
_COMMENT = frozenset("comment comments commentlist discussion disqus reply replies respond".split())
_SPLIT = re.compile(r"[a-z]+|[A-Z][a-z]*")
_TRACKED = frozenset(("p", *_SELF))


class _Tags:
    """The tags of a page in one forward pass: (start, end, closing, name, attributes); name is None in comments and declarations.

    A tag ends at the first ``>`` outside quotes or, where a quote never closes, at the first ``>`` at all.
    Opening quotes that led to no end are remembered, so that no stretch is read through twice."""

    def __init__(self, page: str):
        self.page, self.doomed = page, set()
        self.last = {c: page.rfind(c) for c in "\"'>"}

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at`` (some ``>`` follows)."""
        page, i, opened = self.page, at, []
        while True:
            i = _PLAIN.match(page, i).end()
            if i < len(page) and page[i] == ">":
                return i
            if i >= len(page) or i in self.doomed:
                break
            opened.append(i)
            if i >= self.last[page[i]]:
                break
            i = page.index(page[i], i + 1) + 1
        self.doomed.update(opened)
        return page.index(">", at)

    def after(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """The first tag from ``at`` on."""
        page = self.page
        while True:
            m = _MARK.search(page, at)
            if not m:
                return None
            if m[0] == "<!--":
                end = page.find("-->", m.end())
                return m.start(), end + 3 if end >= 0 else len(page), "", None, ""
            if m.end() <= self.last[">"]:
                end = page.index(">", m.end()) if m[2] is None else self._end(m.end())
                return m.start(), end + 1, m[1] or "", m[2], page[m.end():end]
            at = page.find("<!--", m.end())  # no tag ends any more
            if at < 0:
                return None


class _Node:
    __slots__ = ("tag", "parent", "kids", "bad", "comment", "hidden", "points", "size", "linked", "links", "holds", "ink", "commas", "gone", "scope")

    def __init__(self, tag: str, parent: "_Node | None"):
        self.tag, self.parent, self.kids = tag, parent, []
        self.bad = self.comment = self.hidden = self.holds = self.gone = False
        self.points, self.size, self.linked, self.links, self.ink, self.commas = 0.0, 0, 0, 0, 0, 0
        #: open tags by name since the nearest element that ends a search for them
        self.scope: dict[str, int] = {} if parent is None or tag in _STOP else parent.scope


def _parse(page: str) -> _Node:
    """Element tree; a kid is a node or a string (character references decoded)."""
    root = top = _Node("html", None)
    at, n = 0, len(page)
    tags, opened = _Tags(page), {}

    def close(x: _Node) -> None:
        """``x`` and all open elements in it end."""
        nonlocal top
        while top is not x.parent:
            opened[top.tag] -= 1
            if top.tag in _TRACKED:
                top.scope[top.tag] -= 1
            top = top.parent

    def inside(names: tuple[str, ...]) -> bool:
        return any(top.scope.get(t) for t in names)

    def text(s: str) -> None:
        if s:
            top.kids.append(_html.unescape(s) if "&" in s else s)

    while at < n:
        m = tags.after(at)
        if not m:
            text(page[at:])
            break
        start, end, closing, tag, attrs = m
        text(page[at:start])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if opened.get(tag):
                x = top
                while x.tag != tag:
                    x = x.parent
                close(x)
            continue
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = page.find(">", end.start()) + 1 if end else n
            at = at or n
            continue
        if tag in ("html", "body"):
            continue
        if tag in _CLOSES_P and inside(("p",)):
            x = top
            while x.tag != "p":
                x = x.parent
            close(x)
        if tag in _SELF and inside(_SELF[tag]):
            x = top
            while x.tag not in _SELF[tag]:
                x = x.parent
            while x.tag in _SELF[tag]:
                close(x)
                x = top
        node = _Node(tag, top)
        top.kids.append(node)
        if "=" in attrs or "hidden" in attrs:
            for a in _ATTR.finditer(attrs):
                name, value = (a[1] or a[5]).lower(), a[2] or a[3] or a[4] or ""
                if name in ("class", "id", "role"):
                    found = {w.lower() for w in _SPLIT.findall(value)}
                    node.bad |= bool(found & _BAD)
                    node.comment |= bool(found & _COMMENT)
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                    node.hidden = True
        if tag not in _VOID and (not attrs.endswith("/") or tag in _BLOCK):
            top = node
            opened[tag] = opened.get(tag, 0) + 1
            if tag in _TRACKED:
                node.scope[tag] = node.scope.get(tag, 0) + 1
    return root


def _walk(root: _Node) -> list[_Node]:
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        out.append(x)
        stack.extend(k for k in reversed(x.kids) if type(k) is not str)
    return out


def _sizes(order: list[_Node]) -> None:
    for x in reversed(order):
        x.size = sum(len(k.strip()) for k in x.kids if type(k) is str) + sum(k.size for k in x.kids if type(k) is not str)
        x.linked = x.size if x.tag == "a" else sum(k.linked for k in x.kids if type(k) is not str)
        x.links = (x.tag == "a") + sum(k.links for k in x.kids if type(k) is not str)
        x.ink = sum(len("".join(k.split())) if type(k) is str else k.ink for k in x.kids)
        x.commas = sum(k.count(",") + k.count("،") + k.count("、") if type(k) is str else k.commas for k in x.kids)
        x.holds = x.tag in _SECTION or any(k.holds for k in x.kids if type(k) is not str)


def _blocks(x: _Node | str, out: list[list[str]]) -> None:
    """Text of a subtree as blocks; each inner list is one block's pieces."""
    stack: list = [x]
    while stack:
        x = stack.pop()
        if type(x) is str:
            out[-1].append(x)
        elif x is None:
            out.append([])
        elif x.tag in _BLOCK:
            out.append([])
            stack.append(None)
            stack.extend(reversed(x.kids))
        else:
            stack.extend(reversed(x.kids))


def _own_text(x: _Node) -> str:
    parts: list[list[str]] = [[]]
    _blocks(x, parts)
    return " ".join(" ".join("".join(p) for p in parts).split())


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = _parse(page)
    order = _walk(root)
    _sizes(order)
    all_text = max(root.size, 1)
    inside = set()
    for x in order:  # set boilerplate aside, but nothing that holds the article or most of an unmarked page
        x_in = x.tag in _SECTION or id(x.parent) in inside
        if x_in:
            inside.add(id(x))
        drop = x.hidden or x.tag in _DROP or (x.tag == "header" and not x_in) or x.bad
        # a menu, whatever its name; inside an article or main it may be a list of sources
        drop = drop or x.tag in ("ul", "ol", "div", "section", "table") and not x_in and x.links > 2 and x.linked > 0.8 * x.size
        if drop and x is not root and x.tag not in _SECTION and not x.holds:
            sure = x.hidden or x.comment or x.tag in ("nav", "footer", "head", "aside", "svg")
            if sure or x.size - x.linked <= 0.5 * all_text:
                x.gone = True
    for x in order:
        x.kids = [k for k in x.kids if type(k) is str or not k.gone]
    order = _walk(root)
    _sizes(order)
    for x in order:
        if x.tag in _SECTION:
            x.points += 25
        loose = x.tag not in _PARAGRAPH and x.tag in _BLOCK and any(type(k) is str and len(k.strip()) >= 20 for k in x.kids)
        if (x.tag in _PARAGRAPH and not any(type(k) is not str and k.tag in _PARAGRAPH for k in x.kids)) or loose:
            if loose:
                s = " ".join(k.strip() for k in x.kids if type(k) is str)
                length, commas = len(s), s.count(",") + s.count("،") + s.count("、")
            else:  # from 300 signs on the length has no more weight
                length, commas = x.ink if x.ink >= 300 or not x.ink else len(_own_text(x)), x.commas
            if not length:
                continue
            plain = 1 - (x.linked / x.size if x.size else 0)
            points = (min(1, length / 25) + commas + min(length / 100, 3)) * plain
            up, share = (x if loose else x.parent), 1
            while up is not None and share <= 3:
                up.points += points / share
                up, share = up.parent, share + 1
    best = max(order, key=lambda x: x.points * (1 - (x.linked / x.size if x.size else 0)))
    if not best.points:
        best = root
    up = best
    while up is not root and up.tag not in _SECTION:
        up = up.parent
    if up is not root:
        best = up
    score = best.points * (1 - (best.linked / best.size if best.size else 0))

    def reads(k: _Node | str) -> bool:
        """Whether a sibling of the best container scores close to it or reads like text."""
        if type(k) is str:
            return len(k.strip()) >= 80
        if k.bad and k.holds:  # comments or teasers, not set aside only because they hold articles
            return False
        density = k.linked / k.size if k.size else 1
        heading = k.tag in ("h1", "h2", "h3") and density < 0.5
        prose = k.tag in ("p", *_SECTION) and k.size > 80 and density < 0.25 or k.tag == "p" and 0 < k.size <= 80 and not k.linked and re.search(
            r"[.!?](\s|$)", _own_text(k))
        points = k.points - 25 * (k.tag in _SECTION)  # an article is not body text by its name alone
        return heading or bool(prose) or points * (1 - density) >= max(10, 0.2 * score) and density < 0.5

    main = best
    while main is not root and main.tag != "main":
        main = main.parent
    top = best  # in main, siblings on every level up to it; else those beside the best container
    while top is not main and top.parent is not None and (main is not root or top is best):
        top = top.parent
    path = set()
    x = best
    while x is not None:
        path.add(id(x))
        x = x.parent
    parts: list[list[str]] = [[]]
    stack: list = [top]
    while stack:
        x = stack.pop()
        if x is best:
            parts.append([])
            _blocks(x, parts)
            parts.append([])
        elif type(x) is not str and id(x) in path:
            stack.extend(reversed(x.kids))
        elif reads(x):
            parts.append([])
            _blocks(x, parts)
            parts.append([])
    return " ".join(t for t in (" ".join("".join(p).split()) for p in parts) if t)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = string_column(batch, "html")
            for i, j in doc_blocks(utf8_parts(col)[1], 4 << 20):
                text = [main_text(h) for h in col.slice(i, j - i).to_pylist()]
                text = [t.encode("utf-8", "replace").decode() for t in text]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(text, pa.string()),
                     pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
