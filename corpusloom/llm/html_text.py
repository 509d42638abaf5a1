"""The main text of web pages by tag-path ratios.

A page is read once, from left to right, into elements and text nodes; a node's tag path has the name and class of each
element from the root to the leaf. Per path, the length of text and the punctuation are summed; both, per text node, are
smoothed over neighbouring paths in page order and fused by multiplication. Nodes whose path reaches the threshold are
content. They select the container: the page's article elements if these hold a fair part of the content, else the
innermost element that holds nearly all of it. The result is an article's blocks, short headings and list items included;
of a container that no tag marks, the blocks from the first content to the last, with the headings just before.

What the contract names goes by its tag, or by a class, id or role all of whose words name it: `share-price` and
`notice-of-death` are no adverts. Words that only hint at a side matter (related, share, social) leave it to the ratios:
such an element goes if none of its paths is content. Time is linear in the page.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm._common import shipped

_START = re.compile(r"<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_END = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_PUNCTUATION = re.compile(r"[.,;:!?、。，！？；]")
_WORD = re.compile(r"[a-z]+")

RAW = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*+>", re.I) for n in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas")}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
AWAY = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "head", "fieldset", "label", "option"}
#: Elements that hold the page, its article or a heading or cell of it, whatever their class says.
OWN = {"html", "body", "main", "article", "h1", "h2", "h3", "h4", "h5", "h6", "table", "tbody", "thead", "tfoot", "tr", "th", "td", "math"}
#: Words in class, id or role that name what is not the article; that hint at it; and that say nothing.
AWAY_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "banner", "banners", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "forms", "gdpr", "header", "login", "masthead", "menu", "menus", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promos", "promoted", "promotion", "replies", "reply", "respond",
    "search", "sidebar", "sidebars", "signup", "sponsor", "sponsored", "sponsors", "subscribe",
}
HINT_WORDS = {"modal", "popular", "recommended", "related", "share", "sharing", "skip", "social", "teaser", "teasers", "toolbar", "trending", "widget", "widgets"}
NEUTRAL_WORDS = {
    "area", "article", "bar", "block", "body", "bottom", "box", "button", "buttons", "column", "container", "content", "entry", "fixed", "global", "group", "holder", "inner",
    "item", "items", "left", "link", "links", "list", "main", "mobile", "module", "outer", "page", "panel", "placeholder", "post", "posts", "primary", "region", "reader",
    "readers", "right", "row", "secondary", "section", "site", "slot", "sticky", "stories", "story", "text", "thread", "top", "unit", "user", "wrap", "wrapper", "zone",
}
#: A header of these is the article's own.
PARTS = {"article", "content", "entry", "post", "section", "story"}
#: A path is content if its fused ratio reaches this share of the standard deviation over the page's paths; the width of smoothing.
THRESHOLD, SIGMA = 0.5, 0.5
#: Parts of the content that article elements, or else the innermost container, have to hold.
ARTICLES, CONTAINER = 0.2, 0.9


def _kind(name: str, attributes: str) -> tuple[int, str]:
    """2 if the element is away, 1 if its names hint at that, 0 if not; and its class."""
    kind, style = 2 if name in AWAY else 0, ""
    for m in _ATTRIBUTE.finditer(attributes) if attributes.strip(" /\n\t") else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "class":
            style = " ".join(value.lower().split())
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _NONE.search(value)):
            kind = 2
        elif key in ("class", "id", "role") and name not in OWN:
            for token in value.split():
                words = set(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower()))
                named, hints = words & AWAY_WORDS, words & HINT_WORDS
                if words - named - hints - NEUTRAL_WORDS or not named | hints or (named == {"header"} and words & PARTS):
                    continue
                kind = max(kind, 2 if named else 1)
    return kind, style


class Page:
    """Elements and text nodes of a page.

    An element is (parent, path, kind, is a block, name); a node (element, block, text). Elements and paths are
    numbered, so that no list of ancestors is ever copied.
    """

    def __init__(self, page: str):
        self.elements: list[tuple[int, int, int, bool, str]] = [(-1, 0, 0, True, "")]
        self.nodes: list[tuple[int, int, str]] = []
        self._paths: dict[tuple[int, str, str], int] = {}
        self._open: list[tuple[str, int]] = [("", 0)]
        self._held: dict[str, int] = {}  # open elements of a name
        self._block = 0
        self._read(page)

    def _text(self, text: str) -> None:
        if text:
            self.nodes.append((self._open[-1][1], self._block, html.unescape(text) if "&" in text else text))

    def _close_to(self, k: int) -> None:
        for name, _ in self._open[k:]:
            self._held[name] -= 1
        del self._open[k:]

    def _close(self, name: str) -> None:
        if self._held.get(name):
            for k in range(len(self._open) - 1, 0, -1):
                if self._open[k][0] == name:
                    return self._close_to(k)

    def _close_item(self, name: str) -> None:
        """An item ends the item before it, if no list or table opened between them."""
        names = ("dt", "dd") if name in ("dt", "dd") else (name,)
        if any(self._held.get(n) for n in names):
            for k in range(len(self._open) - 1, 0, -1):
                if self._open[k][0] in names:
                    return self._close_to(k)
                if self._open[k][0] in ("ul", "ol", "table", "dl", "menu"):
                    return None

    def _enter(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._block += 1
            if name not in ("html", "body"):
                self._close("p")
            if name in ("li", "td", "th", "tr", "dt", "dd"):
                self._close_item(name)
        elif name == "option":
            self._close_item(name)
        if name == "br":
            self._text(" ")
        if name in VOID or attributes.endswith("/"):
            return
        parent = self._open[-1][1]
        kind, style = _kind(name, attributes)
        path = self._paths.setdefault((self.elements[parent][1], name, style), len(self._paths) + 1)
        self._open.append((name, len(self.elements)))
        self._held[name] = self._held.get(name, 0) + 1
        self.elements.append((parent, path, kind, name in BLOCKS, name))

    def _leave(self, name: str) -> None:
        self._block += name in BLOCKS
        self._close(name)

    def _read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            tag = page.find("<", at)
            if tag < 0:
                return self._text(page[at:])
            after = page[tag + 1 : tag + 2]
            if after in ("!", "?"):
                self._text(page[at:tag])
                mark = "-->" if page.startswith("<!--", tag) else ">"
                end = page.find(mark, tag + 2)
                at = end + len(mark) if end >= 0 else n
            elif after == "/" and page[tag + 2 : tag + 3].isalpha():
                self._text(page[at:tag])
                if m := _END.match(page, tag):
                    self._leave(m[1].lower())
                at = m.end() if m else n
            elif after.isascii() and after.isalpha():
                self._text(page[at:tag])
                m = _START.match(page, tag)
                if m:
                    name, attributes, at = m[1].lower(), m[2], m.end()
                else:  # a quote that never ends; without any > the rest is one tag
                    end = page.find(">", tag)
                    if end < 0:
                        return
                    name, attributes, at = re.match(r"[^\s/>]+", page[tag + 1 : end])[0].lower(), "", end + 1
                if name in RAW:
                    if not attributes.endswith("/"):
                        end = RAW[name].search(page, at)
                        at = end.end() if end else n
                else:
                    self._enter(name, attributes)
            else:
                self._text(page[at : tag + 1])
                at = tag + 1


def ratios(length: np.ndarray, punctuation: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The fused ratio of each path, from its sums of text and punctuation and its number of nodes; paths in page order."""
    kernel = np.exp(-np.arange(-1, 2) ** 2 / (2 * SIGMA**2))

    def smooth(x):
        return np.maximum(np.convolve(np.pad(x, 1, mode="edge"), kernel / kernel.sum(), "valid"), x * 0.5)

    return smooth(length / nodes) * smooth((punctuation + 1) / nodes)


def main_text(page: str | None) -> str:
    """The blocks of the article, joined by line feeds; empty if the page has none."""
    read = Page(page or "")
    elements = read.elements
    away = [False] * len(elements)
    for k, (parent, _, kind, _, _) in enumerate(elements):
        away[k] = kind == 2 or (parent >= 0 and away[parent])
    # the paths of what is not away, in page order, and their ratios
    places: dict[int, int] = {}
    sums: list[list[int]] = []
    for e, _, text in read.nodes:
        if not away[e] and (size := len(_SPACE.sub(" ", text).strip(" "))):
            row = places.setdefault(elements[e][1], len(sums))
            if row == len(sums):
                sums.append([0, 0, 0])
            sums[row][0] += size
            sums[row][1] += len(_PUNCTUATION.findall(text))
            sums[row][2] += 1
    if not sums:
        return ""
    fused = ratios(*np.array(sums, float).T)
    content = fused >= (THRESHOLD * float(np.std(fused)) if len(fused) > 1 else 0.0)
    # what each element holds of content
    weight = [0] * len(elements)
    for e, _, text in read.nodes:
        if not away[e] and (row := places.get(elements[e][1])) is not None and content[row]:
            weight[e] += len(_SPACE.sub(" ", text).strip(" "))
    for k in range(len(elements) - 1, 0, -1):
        weight[elements[k][0]] += weight[k]
    for k, (parent, _, kind, _, _) in enumerate(elements):
        away[k] = away[k] or (kind == 1 and not weight[k]) or (parent >= 0 and away[parent])
    # the container: outermost articles, or the innermost block that holds nearly all content
    inside = [0] * len(elements)
    for k in range(1, len(elements)):
        inside[k] = inside[elements[k][0]] or (k if elements[k][4] in ("article", "main") and not away[k] else 0)
    chosen = {k for k in range(1, len(elements)) if inside[k] == k}
    marked = bool(chosen) and sum(weight[k] for k in chosen) >= ARTICLES * weight[0]
    if not marked:
        parents = {parent for parent, _, _, is_block, _ in elements if is_block}  # a single leaf is no container
        near = [k for k, (_, _, _, is_block, _) in enumerate(elements) if is_block and weight[k] >= CONTAINER * weight[0] and k in parents]
        chosen = {near[-1] if near else 0}  # those that hold over half of it lie in one another, the innermost last
    within = [False] * len(elements)
    for k, (parent, *_) in enumerate(elements):
        within[k] = k in chosen or (parent >= 0 and within[parent])
    texts: dict[int, list[str]] = {}
    full, heading = set(), set()
    for e, block, text in read.nodes:
        if within[e] and not away[e]:
            texts.setdefault(block, []).append(text)
            if (row := places.get(elements[e][1])) is not None and content[row]:
                full.add(block)
            if elements[e][4] in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heading.add(block)
    said = [(block, _SPACE.sub(" ", "".join(t)).strip(" ")) for block, t in texts.items()]
    said = [(block, text) for block, text in said if text]
    if not marked and full:
        at = [k for k, (block, _) in enumerate(said) if block in full] or [0]
        first = at[0]
        while first and said[first - 1][0] in heading:
            first -= 1
        said = said[first : at[-1] + 1]
    return "\n".join(text for _, text in said)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages without html_col, with text and n_chars (code points) instead.

    A null or empty page gives an empty text. Repeated rows give repeated results, an empty table none; columns of pages
    that are called text or n_chars are replaced.
    """
    kept = [c for c in shipped(pages).columns if c not in (html_col, "text", "n_chars")]
    fields = [pages.schema[c] for c in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                texts = [main_text(x.as_py()) for x in part.column(len(kept))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [f.name for f in fields])

    return pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html_col).cast("string")).mapInArrow(run, T.StructType(fields))
