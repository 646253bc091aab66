"""Main text of web pages by smoothed text-to-tag ratios over the events of the standard library's HTML parser.

The parser's events are read once and in order. Block elements end a line; a line's ratio is its visible characters per
tag. The ratios of a page are smoothed with a Gaussian, and lines whose smoothed ratio reaches the page's threshold form
the content cluster. The clustered characters choose the region, an element of the page; inside it every line stays,
however short, unless it belongs to a part that is named as something else (menus, adverts, comments, …).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIGMA = 1.0
RADIUS = 2
#: A child region is entered, or a named article taken, when it holds this share of the clustered characters around it.
ENTER = 0.6
TAKE = 0.5
#: A list outside of articles is a menu when links hold this share of its characters.
LINKED = 0.8

# Elements that never hold article text, with all that is inside them.
SILENT = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea datalist "
    "menu dialog iframe object canvas svg math audio video map".split()
)
# Elements that end a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
# Elements that end an open element of the second list when they start.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "tbody": ("tbody thead tfoot tr td th", ("table",)),
    "tfoot": ("tbody thead tfoot tr td th", ("table",)),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
REGIONS = frozenset("html body main article section div td table center blockquote details".split())
LISTS = frozenset("ul ol dl dir".split())
# First or last words of class names and ids that mark something other than the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion "
    "banner menu menus nav navbar navigation breadcrumb breadcrumbs masthead header footer sidebar sidebars aside widget "
    "widgets related recommended cookie cookies consent gdpr notice notices notification alert alerts disclaimer popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social comment comments commentlist "
    "disqus discussion reply replies respond form search skip toolbar pagination pager copyright tagcloud outbrain taboola".split()
)
# Words that turn such a mark round, as in "no-sidebar" or "has-banner".
TURNED = frozenset("no not non has have with without hide".split())
# ARIA roles of parts other than the article.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def marked(names: str) -> bool:
    """Whether a class or id attribute has a name that starts or ends with a mark."""
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and (words[0] in MARKS or words[-1] in MARKS) and not TURNED.intersection(words):
            return True
    return False


@dataclass
class Region:
    """An element that may hold the article; the page itself is the first one."""

    tag: str
    parent: int
    article: bool


@dataclass
class Line:
    text: str
    tags: int
    region: int
    menu: int  # the list it belongs to, -1 if none


@dataclass
class Open:
    tag: str
    silent: bool
    header: bool
    region: int
    menu: int


@dataclass
class ListOf:
    inside: bool  # in an article
    chars: int = 0
    linked: int = 0
    items: int = 0


class LineReader(HTMLParser):
    """Turns parser events into lines; keeps the elements that decide on them on a stack, inline ones only if silent."""

    def __init__(self, forms: bool = False):
        """``forms`` reads forms as text, for pages that are one form."""
        super().__init__(convert_charrefs=True)
        self.silent = SILENT - {"form"} if forms else SILENT
        self.lines: list[Line] = []
        self.regions = [Region("page", -1, False)]
        self.lists: list[ListOf] = []
        self.stack = [Open("page", False, False, 0, -1)]
        self.depth: dict[str, int] = {}
        self.parts: list[str] = []
        self.tags = 0
        self.links = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            top = self.stack[-1]
            self.lines.append(Line(text, max(self.tags, 1), top.region, top.menu))
            self.tags = 0

    def _pop(self) -> None:
        top = self.stack.pop()
        self.depth[top.tag] -= 1

    def _close(self, tags: str, within: tuple[str, ...]) -> None:
        """End the open element of ``tags`` that the next one implies, not looking past an element of ``within``."""
        names = tags.split()
        if not any(self.depth.get(n) for n in names):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at].tag
            if tag in within:
                return
            if tag in names:
                while len(self.stack) > at:
                    self._pop()
                if not any(self.depth.get(n) for n in names):
                    return

    def _silences(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in self.silent or attrs.get("role", "").lower() in ROLES or "hidden" in attrs:
            return True
        if attrs.get("aria-hidden", "").lower() == "true" or HIDDEN.search(attrs.get("style", "")):
            return True
        if tag in ("html", "body", "main"):
            return False
        return marked(attrs.get("class", "")) or marked(attrs.get("id", ""))

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        block = tag in BLOCKS
        if block:
            self._end_line()
            self._close("head p" if tag != "html" else "p", ("td", "th"))
            if tag in CLOSES:
                self._close(*CLOSES[tag])
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs}
        top = self.stack[-1]
        mute = self._silences(tag, given)
        heads = (tag == "header" or marked_header(given)) and self.regions[top.region].article and not top.silent
        header = heads or (top.header and not mute)
        silent = (top.silent or mute) and not (tag in HEADINGS and header)  # an article's header keeps its headings
        if tag == "a":
            self.links += 1
        if not block and silent == top.silent:
            return
        region, menu = top.region, top.menu
        if tag in REGIONS:
            self.regions.append(
                Region(tag, region, self.regions[region].article or tag in ("article", "main") or given.get("role") == "main")
            )
            region = len(self.regions) - 1
        if tag in LISTS and menu < 0:
            self.lists.append(ListOf(inside=self.regions[region].article))
            menu = len(self.lists) - 1
        if tag in ("li", "dd") and menu >= 0:
            self.lists[menu].items += 1
        self.stack.append(Open(tag, silent, header and silent, region, menu))
        self.depth[tag] = self.depth.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = max(self.links - 1, 0)
        if tag in BLOCKS:
            self._end_line()
        if self.depth.get(tag):
            while self.stack[-1].tag != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        top = self.stack[-1]
        if top.silent:
            return
        self.parts.append(data)
        if top.menu >= 0:
            self.lists[top.menu].chars += len(data)
            self.lists[top.menu].linked += len(data) if self.links else 0


def read_lines(html: str, forms: bool = False) -> LineReader:
    page = LineReader(forms)
    page.feed(html)
    page.close()
    page._end_line()
    return page


def marked_header(attrs: dict[str, str]) -> bool:
    return any(n.lower().split("-")[-1] == "header" for n in attrs.get("class", "").split())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian mean of each ratio and its neighbours; beyond the ends nothing is added."""
    offsets = np.arange(-radius, radius + 1)
    kernel = np.exp(-(offsets**2) / (2 * sigma**2))
    total = np.convolve(ratios, kernel)[radius : radius + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Lines of the content cluster: their smoothed ratio reaches the deviation of all smoothed ratios of the page."""
    if not len(ratios):
        return np.zeros(0, dtype=bool)
    smooth = smoothed(ratios)
    return smooth >= min(float(smooth.std()), float(smooth.max()))


def _choose(page: LineReader, mass: np.ndarray) -> set[int]:
    """Regions to keep: articles with most of the clustered characters, else the deepest element that has them."""
    regions = page.regions
    total = mass.copy()
    for i in range(len(regions) - 1, 0, -1):  # a parent comes before its children
        total[regions[i].parent] += total[i]
    for tag in ("article", "main"):
        outer = [
            i for i, r in enumerate(regions)
            if r.tag == tag and not _has(regions, r.parent, tag)
        ]
        if outer and total[0] > 0 and sum(total[i] for i in outer) >= TAKE * total[0]:
            return set(outer)
    children: dict[int, list[int]] = {}
    for i, r in enumerate(regions[1:], 1):
        children.setdefault(r.parent, []).append(i)
    at = 0
    while True:
        best = max(children.get(at, []), key=lambda i: total[i], default=None)
        if best is None or total[best] <= 0 or total[best] < ENTER * total[at]:
            return {at}
        at = best


def _has(regions: list[Region], at: int, tag: str) -> bool:
    while at >= 0:
        if regions[at].tag == tag:
            return True
        at = regions[at].parent
    return False


def main_text(html: str | None) -> str:
    """The article of one page, blocks joined by line feeds."""
    if not html:
        return ""
    page = read_lines(html)
    if not page.lines and "<form" in html.lower():
        page = read_lines(html, forms=True)
    if not page.lines:
        return ""
    content = content_lines(np.array([len(x.text) / x.tags for x in page.lines]))
    mass = np.zeros(len(page.regions))
    for line, inside in zip(page.lines, content.tolist(), strict=True):
        if inside:
            mass[line.region] += len(line.text)
    chosen = _choose(page, mass)
    kept = [False] * len(page.regions)
    for i, region in enumerate(page.regions):
        kept[i] = i in chosen or (region.parent >= 0 and kept[region.parent])
    menus = [not x.inside and x.items > 1 and x.linked >= LINKED * max(x.chars, 1) for x in page.lists]
    return "\n".join(x.text for x in page.lines if kept[x.region] and not (x.menu >= 0 and menus[x.menu]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    Kept are the lines of the chosen region, in page order, one per block element: white space inside a block is one
    space, character references are decoded, a line break element is white space. Left out are the elements of
    ``SILENT``, hidden ones, those whose role, class or id marks a menu, header, footer, sidebar, notice, advert, form
    or reader comments, and lists outside of articles that consist of links. The headings of a header inside an article
    stay. A page whose text is all inside forms is read as if they were plain elements.

    Null or empty html and pages without text give an empty string. Null and repeated page_ids, urls and rows are kept,
    a row each; very long pages are read whole; an empty table gives an empty result. Other columns are ignored.
    """
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return plain.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
