"""Main text of web pages by line-block distribution.

A page's markup is cut into lines at block elements. Elements that never hold an article (navigation, headers and
footers, asides, scripts, styles, notices, adverts, reader comments, controls of forms) are skipped with all they contain;
one inside a line leaves the line whole. Each other line has a length, its characters. Lengths are summed over a window of
``window`` lines; the text surges where that sum reaches the threshold and dives where a whole window is empty. What is
between surges and dives is the main text, all such runs of it; headings directly before a surge belong to it.

Weights. Where the page marks articles (``article`` or ``main``), marked lines and the others are two texts, and a marked
character weighs ``WEIGHT``-fold. The text with the larger total of its runs is the main one and the other's lines have length
zero, so a marked teaser or comment doesn't stand for a long unmarked text, whether it is before, in or after it. A marked
line of the main text reaches the threshold by itself. Lines in lists that are nothing but a link have length zero unless they are
marked; a list of nothing but links that are shorter than a line's share of the threshold is a menu and is left out.

Marks that mislead. A form that holds an article, or most of the page, is a wrapper and is read; any other one is left out. Of a
header inside an article its headings stay. An element that is never closed is read as if it were not there, but for an unclosed
footer, which ends at the next article or first-level heading. A class or id speaks for boilerplate only by a whole
word of it, alone or with words for containers (``comments-list``), not by states (``has-sidebar``, ``comments-enabled``).

Inside a line, character references are decoded and white space becomes one space. Lines are joined by one line feed.
Null and empty pages, and pages without text, give the empty string. Broken markup (open tags, cut-off pages, stray
``<``) is read as far as it goes. Pages are independent; repeated rows give equal results, other columns stay. A page is
read whole, with no limit on its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 3
THRESHOLD = 60  # characters in a window that make a surge
WEIGHT = 4  # of a marked character

_NAME = r"[a-zA-Z][^\s/>]*"
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(/?)({_NAME})((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?{_NAME}[^>]*(?:>|\Z)|[^<]+|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role|aria-label|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
BOILERPLATE = RAW | {
    "head", "nav", "header", "footer", "aside", "menu", "button", "select", "option", "template", "svg",
    "canvas", "object", "dialog", "input", "label", "fieldset", "audio", "video", "map",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
    "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
    "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
LISTS = {"ul", "ol"}
BOILERPLATE_NAME = re.compile(
    r"""(?ix)(?:^|\s)(?!(?:has|no|not|with|without|hide|show|is|js|enable|disable)[-_])(?:[^\s_-]+[_-]+)*?
    (?:ads?|adverts?|advertisements?|advertising|banner|promo|promotion|sponsor(?:ed)?|sidebar|side-?bar|menu|nav|navbar
    |navigation|breadcrumbs?|cookies?|consent|gdpr|notices?|newsletter|subscribe|subscription|signup|login|popup|modal|overlay
    |share|sharing|social|related|recommended|widget|footer|masthead|comments?|replies|respond|disqus|pagination|pager|tags?
    |toolbar|copyright|disclaimer|skip-?link)
    (?:[_-]+(?:area|articles?|bar|block|body|bottom|box|buttons?|container|content|form|frame|group|icons?|inner|items?|left
    |links?|list|outer|panel|posts?|right|section|slot|stories|thread|top|unit|widget|wrap|wrapper|\d+))*(?=$|\s)"""
)
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
SPEAKING = {"div", "section", "ul", "ol", "p", "span", "table", "dl", "li", "article", "figure", "details"}


class Tag(NamedTuple):
    name: str
    closing: bool
    attributes: str


class Line(NamedTuple):
    text: str
    marked: bool  # in an article
    heading: bool
    linked: bool  # in a list, and nothing but a link
    menu: int  # the list that holds it, or 0
    form: int  # the form that holds it, or 0


def _skips(name: str, attributes: str) -> bool:
    if name in BOILERPLATE:
        return True
    if not attributes or name not in SPEAKING:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        key = key.lower()
        if key in ("class", "id") and BOILERPLATE_NAME.search(value):
            return True
        if key == "role" and value.lower() in BOILERPLATE_ROLES:
            return True
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
    return False


def tokens(page: str) -> list[str | Tag]:
    """Pieces of text and tags in page order, without comments and what is inside raw elements."""
    found: list[str | Tag] = []
    position, size = 0, len(page)
    while position < size:
        m = _TOKEN.match(page, position)
        position = m.end()
        if m[2] is not None:
            tag = Tag(m[2].lower(), bool(m[1]), m[3])
            if tag.name not in RAW:
                found.append(tag)
            elif not tag.closing:  # what is inside is not markup
                close = re.compile(rf"</{tag.name}\b[^>]*>", re.I).search(page, position)
                position = close.end() if close else size
        elif m[0][0] != "<" or m[0] == "<":
            found.append(m[0])
    return found


def closings(found: list[str | Tag]) -> dict[int, int]:
    """For each opening tag its closing one, by place; unclosed tags are left out."""
    opened: dict[str, list[int]] = {}
    pairs = {}
    for i, token in enumerate(found):
        if isinstance(token, Tag):
            if not token.closing:
                opened.setdefault(token.name, []).append(i)
            elif opened.get(token.name):
                pairs[opened[token.name].pop()] = i
    return pairs


class _Page:
    """Reads the tokens of one page into lines."""

    def __init__(self, page: str) -> None:
        self.tokens = tokens(page)
        self.pairs = closings(self.tokens)
        self.lines: list[Line] = []
        self.wrappers: set[int] = set()  # forms that hold an article
        self.parts: list[str] = []
        self.beside = False  # letters or digits outside links
        self.link = self.heading = False
        self.article = 0
        self.lists: list[int] = []
        self.form = self.form_end = self.header_end = -1

    def end_line(self) -> None:
        text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip() if self.parts else ""
        if text and (self.heading or self.header_end < 0):
            menu = self.lists[-1] if self.lists else 0
            self.lines.append(
                Line(text, self.article > 0, self.heading, bool(menu) and not self.beside, menu, max(self.form, 0))
            )
        self.parts, self.beside = [], False

    def read(self) -> _Page:
        i = 0
        while i < len(self.tokens):
            token = self.tokens[i]
            if isinstance(token, Tag):
                i = self.tag(i, token)
            else:
                self.parts.append(token)
                if not self.link and not self.beside:
                    self.beside = any(map(str.isalnum, html.unescape(token)))
            i += 1
        self.end_line()
        return self

    def tag(self, i: int, tag: Tag) -> int:
        """The place of the last token that the tag at ``i`` has settled."""
        name = tag.name
        if name in BLOCKS:
            self.end_line()
            self.heading = name in HEADINGS and not tag.closing
        if i == self.form_end:
            self.form = self.form_end = -1
        if i == self.header_end:
            self.header_end = -1
        if not tag.closing:
            if name == "header" and self.article:
                self.header_end = self.pairs.get(i, -1)
                return i
            if _skips(name, tag.attributes):
                return self.skipped(i, name)
        if name == "a":
            self.link = not tag.closing
        elif name == "br":
            self.parts.append(" ")
        elif name in ARTICLE:
            self.article = max(0, self.article + (-1 if tag.closing else 1))
            if self.form > 0 and not tag.closing:
                self.wrappers.add(self.form)
        elif name in LISTS:
            if not tag.closing:
                self.lists.append(i + 1)
            elif self.lists:
                self.lists.pop()
        elif name == "li":
            self.link = False
        elif name == "form" and not tag.closing and i in self.pairs and self.form < 0:
            self.form, self.form_end = i + 1, self.pairs[i]
        return i

    def skipped(self, i: int, name: str) -> int:
        if i in self.pairs:
            last = self.pairs[i]
            if i < self.form_end < last:
                self.form = self.form_end = -1
            if i < self.header_end < last:
                self.header_end = -1
            return last
        if name != "footer":
            return i
        for j in range(i + 1, len(self.tokens)):
            if isinstance(self.tokens[j], Tag) and self.tokens[j].name in (*ARTICLE, "h1") and not self.tokens[j].closing:
                return j - 1
        return len(self.tokens)


def page_lines(page: str, window: int = WINDOW, threshold: int = THRESHOLD) -> list[Line]:
    """The lines outside boilerplate elements, menus and forms."""
    read = _Page(page).read()
    sizes: dict[int, int] = {}
    listed: dict[int, list[Line]] = {}
    for line in read.lines:
        sizes[line.form] = sizes.get(line.form, 0) + len(line.text)
        if line.menu:
            listed.setdefault(line.menu, []).append(line)
    whole = sum(sizes.values())
    wrappers = read.wrappers | {0} | {f for f, n in sizes.items() if n >= threshold and 2 * n > whole}
    menus = {
        m for m, lines in listed.items()
        if all(x.linked for x in lines) and sum(len(x.text) for x in lines) * window < threshold * len(lines)
    }
    return [x for x in read.lines if x.form in wrappers and x.menu not in menus]


def runs(lengths: np.ndarray, leading: np.ndarray, window: int, threshold: int) -> list[tuple[int, int]]:
    """Bounds of all runs of lines between surge and dive, with the ``leading`` lines directly before them."""
    n = len(lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    sums = ends[np.minimum(np.arange(n) + window, n)] - ends[:-1]
    found: list[tuple[int, int]] = []
    i = before = 0
    while i < n:
        if sums[i] < threshold or not lengths[i]:
            i += 1
            continue
        start = end = i
        while end < n and sums[end] > 0:  # dive: a whole window without text
            end += 1
        while start > before and leading[start - 1] and lengths[start - 1]:
            start -= 1
        found.append((start, end))
        before = i = end
    return found


def main_text(page: str | None, window: int = WINDOW, threshold: int = THRESHOLD) -> str:
    lines = page_lines(page, window, threshold) if page else []
    if not lines:
        return ""
    marked = np.array([x.marked for x in lines])
    headings = np.array([x.heading for x in lines])
    lengths = np.array([0 if x.linked and not x.marked else len(x.text) for x in lines], np.int64)

    def kept(weights: np.ndarray) -> list[tuple[int, int]]:
        least = max(1, min(threshold, int(weights.max())))
        return runs(weights, headings, window, least)

    outside = np.where(marked, 0, lengths)
    found, chosen = kept(outside), ~marked
    inside = int(lengths[marked].sum()) * WEIGHT
    if inside and inside >= sum(int(outside[a:b].sum()) for a, b in found):
        found, chosen = kept(np.where(marked, np.maximum(lengths * WEIGHT, threshold), 0)), marked
    return "\n".join(lines[i].text for a, b in found for i in range(a, b) if chosen[i])


def extract_text(
    pages: DataFrame, html_column: str = "html", window: int = WINDOW, threshold: int = THRESHOLD
) -> DataFrame:
    """``pages`` with ``text``, the main text of each page."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p.as_py(), window, threshold) for p in batch], pa.string())

    return pages.withColumn("text", extract(F.col(html_column)))
