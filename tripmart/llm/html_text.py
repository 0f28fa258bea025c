"""Operator 10: main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element, in page order. Scripts, styles, comments,
forms, menus, page headers and footers, sidebars and elements whose class, id or role names a
notice, advert or comment area (and hold no more than half of the text) give no lines, nor does markup without text, so distances count lines
of text only. Each line's length is its text outside links; the block length at a line is the sum over
the ``WINDOW`` lines around it. The text surges where the block length rises from zero and dives
where it falls back (at runs of lines that are links). The span between them with most text is the
main one, and any other whose longest line reaches ``PEER`` of its longest goes with it; all lines from
the first of these spans to the last are kept, whatever their length. Where a page marks an article (article, main or the role main), its lines
of links have weight too, the block length falls back only at the area's end, and its areas are weighed against
the other spans as one: with at least as much text as the longest of them they are the text, else they are spans like others. Article elements of comments and teasers
(by class, id or role) mark nothing. One inside boilerplate counts only if that was left open. Implied end tags are HTML's: a new paragraph, item
or cell ends an open one, and an element ends with its parent, and so does what is left out with it.
A link that is left open ends at the next link or the end of its line.

Character references are decoded, white space in a line becomes one space, lines are trimmed and
joined by two line feeds. Truncated markup is read to the end of the page. Pages are independent:
one narrow pass without a shuffle.

Defined results: null, empty or textless html gives an empty text; repeated rows and null page_ids
each get their own text; null urls stay null. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import in_arrow

WINDOW = 3
PEER = 0.5

#: Elements of HTML by their part in a page.
RAW = {"script", "style", "template", "iframe", "object", "svg", "canvas", "textarea", "title", "select", "audio", "video",
       "annotation", "annotation-xml"}
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
          "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary",
          "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words of classes and ids that name boilerplate. A name counts if all its parts are such words or
#: ``SIDE`` words (numbers too): related-posts does, related-work and ad-hoc-methods do not.
AREAS = re.compile(
    r"ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banners?|side-?bars?|menus?|nav(?:bar|igation)?|"
    r"breadcrumbs?|footer|masthead|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter|subscribe|subscription|"
    r"signup|login|comments?|respond|disqus|replies|related|recommended|share|sharing|social|widgets?|toolbar|pagination|pager|search|skip")
SIDE = re.compile(
    r"[0-9]+(?:x[0-9]+)?|site|page|main|global|primary|secondary|tertiary|top|bottom|left|right|header|head|body|inner|outer|mobile|desktop|"
    r"sticky|fixed|floating|area|bar|box|block|blocks|container|content|wrap|wrapper|section|sections|panel|pane|zone|unit|units|slot|slots|"
    r"placeholder|label|link|links|list|lists|item|items|button|buttons|btn|icon|icons|form|field|input|toggle|title|thread|posts?|articles?|"
    r"stories|story|news|media|google|gpt|dfp|taboola|outbrain|facebook|twitter|policy|law|eu|message|text|info|warning|success|danger|error|"
    r"close|sub|js|the|to|and|ui|col|columns?|row|group|tools|trail|dropdown|results?|reply|count|meta|dialog|window|lightbox|email|mail|user|web")
#: Areas that may be longer than the text they go with.
REMARKS = re.compile(r"ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed)?|comments?|respond|disqus|replies|cookies?|consent|gdpr")
#: Classes and ids of article elements that are not the page's article.
ARTICLES = {"comment", "comments", "reply", "replies", "teaser", "teasers", "related", "recommended", "ad", "ads", "advert",
            "advertisement", "sponsored", "promo", "widget", "related-post", "related-posts", "related-article", "related-articles"}
#: Elements whose end tag may be left out: they end in the right place without it.
OPTIONAL = {"p", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "head"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Implied end tags: what a table's part ends, and the elements that no implied end goes beyond.
PARTS = {"td": ("td", "th", "caption"), "th": ("td", "th", "caption"), "tr": ("tr", "caption"),
         **dict.fromkeys(("tbody", "thead", "tfoot"), ("tbody", "thead", "tfoot", "caption"))}
CELLS = {"table", "td", "th", "caption"}
ITEM_STOPS = BLOCKS - {"address", "div", "p", "li", "dd", "dt"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
         "menubar", "toolbar", "note"}

#: Quotes open a value only after an equals sign; without its end quote, a value ends with the tag.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*+)>|<(?=[/a-zA-Z])[^<]*\Z", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")


def _area(name: str, words: re.Pattern = AREAS) -> bool:
    """Whether one class or id names such an area."""
    if words.fullmatch(name):
        return True
    parts = [x for x in re.split(r"[-_]+", name) if x]
    return any(words.fullmatch(x) for x in parts) and all(AREAS.fullmatch(x) or SIDE.fullmatch(x) for x in parts)


#: How surely an element is boilerplate; from ``LIKELY`` down, one that holds most of the text is not,
#: at ``REMARK`` one that holds all of it.
NO, LIKELY, REMARK, SURE = range(4)


def _boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    if tag in BOILERPLATE or tag == "header" and not in_article:
        return SURE
    if not attributes or tag in ("html", "body"):
        return NO
    found = NO
    for name, *value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(value).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        if name == "role" and value in ROLES:
            found = max(found, LIKELY)
        if name == "class" or name == "id" and tag not in HEADINGS:
            for x in value.split():
                if x in ARTICLES if tag in ("article", "main") else _area(x):
                    found = max(found, REMARK if _area(x, REMARKS) else LIKELY)
    return found


def _is_main(attributes: str) -> bool:
    return "role" in attributes.lower() and any(
        name.lower() == "role" and "main" in "".join(value).lower().split() for name, *value in ATTRIBUTE.findall(attributes))


class Element:
    """An element of the page; ``ended``: by its own end tag."""

    __slots__ = ("tag", "parent", "own", "article", "line", "ended", "skipped", "left_open", "mass")

    def __init__(self, tag: str, parent: Element | None, own: int, article: Element | None, line: int):
        self.tag, self.parent, self.own, self.article, self.line = tag, parent, own, article, line
        self.ended = self.skipped = False
        self.mass = 0  # characters outside links
        self.left_open = True  # all boilerplate elements around it, and itself if it is one


class Open:
    """The open elements, outermost first, with HTML's implied end tags."""

    def __init__(self):
        self.stack = [Element("", None, NO, None, 0)]
        self.count: Counter[str] = Counter()  # open elements by tag
        self.links: list[Element] = []

    def push(self, element: Element) -> None:
        self.stack.append(element)
        self.count[element.tag] += 1
        if element.tag == "a":
            self.links.append(element)

    def remove(self, first: int, end: int | None = None) -> None:
        for element in self.stack[first:end]:
            self.count[element.tag] -= 1
            if element.tag == "a":
                self.links.remove(element)
        del self.stack[first:end]

    def close(self, tags: tuple[str, ...], stops: set[str], by_tag: bool = False) -> None:
        """End the innermost open element of ``tags`` inside the nearest of ``stops``, with all in it; an
        inline element that blocks lie in ends alone."""
        if not any(self.count[t] for t in tags):
            return
        block = False
        for k in range(len(self.stack) - 1, 0, -1):
            element = self.stack[k]
            if element.tag in tags:
                element.ended = by_tag
                self.remove(k, k + 1 if block and element.tag not in BLOCKS else None)
                return
            if element.tag in stops:
                return
            block = block or element.tag in BLOCKS

    def before(self, tag: str) -> None:
        """What the start of ``tag`` ends."""
        if tag not in ("html", "head"):
            self.close(("head",), set())
        if tag == "li":
            self.close(("li",), ITEM_STOPS)
        elif tag in ("dd", "dt"):
            self.close(("dd", "dt"), ITEM_STOPS)
        elif tag in PARTS:
            self.close(PARTS[tag], {"table"} if tag not in ("td", "th") else {"table", "tr"})
        elif tag == "a":
            self.close(("a",), CELLS)
        if tag in BLOCKS and tag not in PARTS:
            self.close(("p",), CELLS)
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.remove(len(self.stack) - 1)

    def end(self, tag: str) -> None:
        stops = {"table"} if tag in PARTS else set() if tag in ("table", "html", "body") else CELLS
        self.close((tag,), stops | {"ul", "ol", "menu"} if tag == "li" else stops, True)


def page_lines(page: str) -> list[tuple[str, int, Element | None]]:
    """(text, characters outside links, the marked article it is in) of every line; boilerplate is empty."""
    opened = Open()
    root = opened.stack[0]
    elements: list[Element] = []  # parents first
    texts: list[tuple[int, str, Element, Element | None]] = []  # line, text, element, link
    line = at = 0

    def text(raw: str) -> None:
        if raw:
            texts.append((line, entities.unescape(raw), opened.stack[-1], opened.links[-1] if opened.links else None))

    while m := TOKEN.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing = bool(m[1])
        if tag in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            line += 1
        elif tag == "br":
            text(" ")
        if closing:
            opened.end(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                opened.before(tag)
            continue
        if m[3].endswith("/") and tag not in BLOCKS:
            continue
        opened.before(tag)
        parent = opened.stack[-1]
        element = Element(tag, parent, _boilerplate(tag, m[3], parent.article is not None), parent.article, line)
        if tag in ("article", "main") or tag in ("div", "section") and _is_main(m[3]):
            element.article = element.article or element
        elements.append(element)
        opened.push(element)
    text(page[at:])

    def plain(n: int, raw: str, link: Element | None) -> int:
        # a link without an end tag ends with the line it starts on
        return sum(map(len, raw.split())) if link is None or not link.ended and n > link.line else 0

    if any(LIKELY <= x.own < SURE for x in elements):
        for n, raw, element, link in texts:
            element.mass += plain(n, raw, link)
        for element in reversed(elements):
            if element.own != SURE:
                element.parent.mass += element.mass
        whole = root.mass
        for element in elements:
            if element.own == LIKELY and 2 * element.mass > whole or element.own == REMARK and 0 < element.mass == whole:
                element.own = NO
    for element in elements:
        up = element.parent
        # an article in boilerplate that was left open is none of it
        element.skipped = element.own != NO or up.skipped and not (element.tag in ("article", "main") and up.left_open)
        element.left_open = up.left_open and not (element.own and (element.ended or element.tag in OPTIONAL))
        if element.article and element.article.own:
            element.article = up.article or (element if element.tag in ("article", "main") and not element.own else None)
    lines: list[tuple[str, int, Element | None]] = []
    for _, group in itertools.groupby(texts, key=lambda x: x[0]):
        parts = [x for x in group if not x[2].skipped]
        lines.append((" ".join("".join(raw for _, raw, _, _ in parts).split()), sum(plain(n, raw, link) for n, raw, _, link in parts),
                      next((element.article for _, _, element, _ in parts if element.article), None)))
    return lines


def _spans(length: list[int], area: list) -> list[tuple[int, int]]:
    """(first line, end line) from each surge to the next dive; none goes beyond an area."""
    spans, a = [], 0
    for _, group in itertools.groupby(range(len(length)), key=lambda i: id(area[i])):
        b = a + sum(1 for _ in group)
        start = None
        for i in range(a, b + 1):
            block = i < b and sum(length[max(a, i - WINDOW // 2):min(b, i + WINDOW // 2 + 1)])
            if block and start is None:
                start = i
            elif not block and start is not None:
                spans.append((start, i))
                start = None
        a = b
    return spans


def main_text(page: str | None) -> str:
    lines = [x for x in page_lines(page or "") if x[0]]  # distance counts lines of text, not markup
    length, area = [n for _, n, _ in lines], [x for _, _, x in lines]
    # a mark gives weight to lines that are links, so that the text falls back only where the area ends
    spans = _spans([max(n, 1) if x else n for n, x in zip(length, area)], area)
    if not spans:
        return ""
    marked = sum(n for n, x in zip(length, area) if x)
    size = [marked if area[a] else sum(length[a:b]) for a, b in spans]  # marked spans go together
    main = max(range(len(spans)), key=lambda k: (size[k], area[spans[k][0]] is not None))
    if area[spans[main][0]]:
        return "\n\n".join(line for a, b in spans if area[a] for line, _, _ in lines[a:b])
    longest = max(length[slice(*spans[main])])
    kept = [(a, b) for k, (a, b) in enumerate(spans) if k == main or max(length[a:b]) >= PEER * longest]
    return "\n\n".join(line for line, _, _ in lines[kept[0][0]:kept[-1][1]])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                text = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return in_arrow(pages.select(pages.page_id.cast("long").alias("page_id"), "url", "html"), run,
                    "page_id long, url string, text string, n_chars long")
