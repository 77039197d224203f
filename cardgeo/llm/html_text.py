"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with the path of tags from the root
to it. Text length and punctuation are aggregated per path; a path's ratios are
text per block and punctuation per block. Their product is smoothed over the
blocks in page order, fused with the path's own value by the geometric mean
and compared with a threshold; paths above it are content. Being inside
``article`` or ``main`` multiplies a path's value: markup is weak evidence, the
ratios decide. From the root, the article is the deepest element that still
holds nearly all content, and every block in it is kept, short ones too, except
what markup names as something else: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, blocks or words
inside a block. What markup names so is content all the same if it is the page's
``html``, ``body``, ``main`` or ``article``, or if a class or a form holds nearly
the whole page's text.

White space inside a block becomes one space, blocks are joined by one \n,
character references are decoded. Pages are independent rows; no page's work
depends on another's. Reading takes time and memory in proportion to the page:
tags are found by forward searches, paths are numbers with parents, and an end
tag looks for its element only if one is open. Defined results: null or blank
html has an empty text; null ids, urls and repeated rows are extracted like any
other; a quote or a tag without its end is text.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: A path is content above this share of the best path's fused ratio.
SHARE = 0.2
#: What a path inside ``CONTENT`` counts more.
WEIGHT = 4.0
#: Share of the content that the article holds, and of a page's text from which
#: a class or a form is the page.
ARTICLE, PAGE = 0.9, 0.9
#: Weights of a block's neighbours in the smoothing, from itself outwards.
SMOOTH = (1.0, 0.5, 0.25)

#: Element names of HTML by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "textarea", "title", "noframes", "object",
       "canvas", "audio", "video")
NOT_CONTENT = frozenset("head nav footer aside form button select menu dialog label fieldset datalist".split()) | {*RAW}
CONTENT = frozenset("article main".split())
#: Never dropped by what their class says; dropped as elements, but not where
#: they hold a whole page.
FRAME, MAY_BE_PAGE = frozenset("html body main article".split()), frozenset("form fieldset header label".split())
#: An element that opens closes these, if open just above it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
          "tfoot": {"tbody", "tr", "td", "th"}}
#: Words of class, id and role that name other things than content.
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo "
    "promoted promotion related reply replies share sharing sidebar sidebars signup skip social sponsor sponsored "
    "subscribe toolbar tooltip widget widgets".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile("[\"'>]")
_RAW_END = {name: re.compile(f"</{name}\\s*>", re.I) for name in RAW}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS = re.compile(r"[a-z]+", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?、。，！？]")


@dataclass(eq=False)
class Element:
    name: str
    parent: "Element | None"
    path: int  # number of its path of tags
    content: bool  # in an article or a main element
    flag: str = ""  # what names it as no content: "tag", "class", or nothing
    size: int = 0  # characters of text in it
    other: bool = False

    def __post_init__(self):
        self.block = self if self.parent is None or self.name in BLOCKS else self.parent.block


@dataclass
class Block:
    element: Element
    parts: list[tuple[Element, str]]
    text: str = ""  # what markup does not name as something else

    def read(self) -> None:
        self.text = " ".join(html.unescape("".join(t for e, t in self.parts if not e.other)).split())


class _Reader:
    """Builds the elements and blocks of one page."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.top = Element("", None, 0, False)
        self.elements, self.blocks, self.held = [self.top], [], []
        self.open_names: dict[str, int] = defaultdict(int)

    def flush(self) -> None:
        if any(not t.isspace() for _, t in self.held):
            self.blocks.append(Block(self.top.block, self.held))
        self.held = []

    def text(self, text: str) -> None:
        self.held.append((self.top, text))

    def pop(self) -> None:
        self.open_names[self.top.name] -= 1
        self.top = self.top.parent

    def close(self, name: str) -> None:
        if self.open_names[name] > 0:
            while self.top.name != name:
                self.pop()
            self.pop()

    def open(self, name: str, rest: str) -> None:
        if name in BLOCKS:
            # A paragraph ends where another block begins.
            if self.top.block.name == "p":
                while self.top.name != "p":
                    self.pop()
                self.pop()
            while self.top.name in CLOSES.get(name, ()):
                self.pop()
        if name in VOID:
            return
        flag = ""
        if name in NOT_CONTENT or name == "header" and not self.top.content:
            flag = "class" if name in MAY_BE_PAGE else "tag"
        elif rest and name not in FRAME and self._says_other(rest):
            flag = "class"
        elif rest and _HIDDEN.search(rest):
            flag = "tag"
        path = self.paths.setdefault((self.top.path, name), len(self.paths) + 1)
        self.top = Element(name, self.top, path, self.top.content or name in CONTENT, flag)
        self.elements.append(self.top)
        self.open_names[name] += 1

    @staticmethod
    def _says_other(rest: str) -> bool:
        words = (w.lower() for m in _NAMED.finditer(rest) for w in _WORDS.findall(m[1] or m[2] or m[3] or ""))
        return not OTHER_WORDS.isdisjoint(words)


def _tag_end(page: str, at: int, missing: set[str]) -> int:
    """Place of the ``>`` that ends a tag, quoted ones passed over; -1: none.
    A quote that never ends is no quote, and is not looked for again."""
    while m := _EDGE.search(page, at):
        if m[0] == ">":
            return m.start()
        at = m.end()
        if m[0] not in missing:
            close = page.find(m[0], at)
            if close < 0:
                missing.add(m[0])
            else:
                at = close + 1
    return -1


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``("text", text, "")``, ``("open", name, attributes)`` and ``("close",
    name, "")``; comments, declarations and raw elements are left out."""
    at, end, last, missing = 0, len(page), page.rfind(">"), set()
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        if page[lt + 1:lt + 2] in ("!", "?", "/") and not (page[lt + 1] == "/" and _NAME.match(page, lt + 2)):
            close = page.find(">", lt) if lt < last else -1
            at = end if close < 0 else close + 1
            continue
        closing = page.startswith("</", lt)
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            yield "text", "<", ""
            at = lt + 1
            continue
        gt = _tag_end(page, name.end(), missing) if lt < last else -1
        if gt < 0:  # no tag ends from here on; what looks like one at the very end is cut off
            more = page.find("<", lt + 1)
            if more < 0:
                return
            yield "text", page[lt:more], ""
            at = more
            continue
        tag, rest = name[0].lower(), page[name.end():gt]
        at = gt + 1
        if closing:
            yield "close", tag, ""
        elif tag in _RAW_END:
            if not rest.endswith("/") or tag in ("script", "style", "textarea", "title"):
                close = None if tag in missing else _RAW_END[tag].search(page, at)
                if close is None:
                    missing.add(tag)
                    return  # it lasts to the end of the page
                yield "text", " " if tag not in ("svg", "math") else "", ""
                at = close.end()
        else:
            yield "open", tag, rest


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, their elements marked as content or other."""
    r = _Reader()
    for kind, name, rest in tokens(page):
        if kind == "text":
            if name:
                r.text(name)
            continue
        if name in BLOCKS:
            r.flush()
        elif name == "br":
            r.text(" ")
        if kind == "close":
            r.close(name)
        else:
            r.open(name, rest)
    r.flush()
    for b in r.blocks:
        for e, t in b.parts:
            e.size += len(t.strip())
    for e in reversed(r.elements[1:]):  # children come after their parents
        e.parent.size += e.size
    whole = r.elements[0].size
    for e in r.elements[1:]:
        named = e.flag == "tag" or e.flag == "class" and e.size < PAGE * whole
        e.other = e.parent.other or named
    for b in r.blocks:
        b.read()
    return [b for b in r.blocks if b.text]


def fused_ratios(blocks: list[Block]) -> dict[int, float]:
    """The fused ratio of each path, by its number."""
    size, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    inside = {}
    for b in blocks:
        path, text = b.element.path, b.text
        size[path] += len(text)
        marks[path] += len(_PUNCTUATION.findall(text))
        count[path] += 1
        inside[path] = b.element.content
    own = {p: (size[p] / count[p]) * (1 + marks[p] / count[p]) for p in count}
    raw = [own[b.element.path] for b in blocks]
    smooth = defaultdict(float)
    for i, b in enumerate(blocks):
        total = weight = 0.0
        for d, w in enumerate(SMOOTH):
            for j in {i - d, i + d}:
                if 0 <= j < len(raw):
                    total, weight = total + w * raw[j], weight + w
        smooth[b.element.path] += total / weight / count[b.element.path]
    return {p: (own[p] * smooth[p]) ** 0.5 * (WEIGHT if inside[p] else 1.0) for p in own}


def path_ratios(blocks: list[Block]) -> dict[str, float]:
    """The fused ratios by the paths' names, to look at."""
    fused, named = fused_ratios(blocks), {}
    for b in blocks:
        names, e = [], b.element
        while e.parent is not None:
            names.append(e.name)
            e = e.parent
        named["/" + "/".join(reversed(names))] = fused[b.element.path]
    return named


#: Elements that are no article by themselves.
_PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre".split())


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    fused = fused_ratios(blocks)
    least = SHARE * max(fused.values())
    # Content under each element that has some, from the blocks up to the root.
    held: dict[Element, int] = defaultdict(int)
    for b in blocks:
        if fused[b.element.path] >= least:
            held[b.element] += len(b.text)
    total, under = sum(held.values()), defaultdict(int)
    children: dict[Element, list[Element]] = defaultdict(list)
    seen = set()
    for e in held:
        while e is not None and e not in seen:
            seen.add(e)
            if e.parent is not None:
                children[e.parent].append(e)
            e = e.parent
    root = next(e for e in seen if e.parent is None)
    order = [root]
    for e in order:
        order += children[e]
    for e in reversed(order):
        under[e] += held.get(e, 0)
        if e.parent is not None:
            under[e.parent] += under[e]
    article = root
    while best := [c for c in children[article] if under[c] >= ARTICLE * total and c.name not in _PARTS]:
        article = best[0]
    known = {article: True, root: article is root}  # whether an element is in the article
    out = []
    for b in blocks:
        chain, e = [], b.element
        while e not in known:
            chain.append(e)
            e = e.parent
        known.update(dict.fromkeys(chain, known[e]))
        if known[b.element]:
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of a column."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None) if len(batch) else batch

    return text_batches(pages).withColumn(text_col, text(F.col(html_col)))
