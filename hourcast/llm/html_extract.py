"""Main text of web pages: parser events, text-to-tag ratio, Gaussian smoothing, threshold clustering.

The standard library's parser streams its events into lines, one for each block of text
(paragraph, heading, list item, table row).  A line's ratio is its characters over its
tags.  The ratios are smoothed with a Gaussian kernel, and lines at or above a threshold (a share of
the ratios' standard deviation) form the content clusters.  The region is the deepest
element that holds nearly all characters of these clusters, widened to the article it is a part of:
the article or main element around it if there is one (main, if only that has the headings), else
out of lists, tables, sections and the like, to a heading if it holds none, and on while nothing but
text is added beside it, that is no navigation, sidebar or page footer.  All its lines are the article, short ones too, as only an element's role drops a line: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, known by tag, role, class or
id, hidden elements, and lines that are nothing but several links.

A name or a form may also wrap the article itself.  Where what is kept holds no article, main or h1
with text, or nearly none of the page's text, the dropped element that holds an article, a main, an h1
or else most of the text is looked through, and its parts are judged by themselves; reader comments,
navigation, footers and hidden elements never are.  Of an article's own header its headings stay.

Character references are decoded; white space in a block becomes one space, at its ends
none; blocks are joined by two line feeds in page order.  ``br`` and table cells count as
white space in their block.

Defined results
---------------
* null or empty html, or a page without main text: empty text, 0 characters.
* broken markup: an end tag closes the elements opened since its start tag; an element
  never closed lasts to the end of its parent; a new block ends an open paragraph.
* repeated rows are extracted each; further columns of the input are passed through; one that bears
  the name of a result column is an error; an empty table gives an empty result.
* very long pages are parsed whole, once for each wrapper looked through (``MAX_WRAPPERS`` at most);
  memory is in proportion to the page.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from hourcast.llm.common import append_columns

# Element names of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
             "summary table tbody tfoot thead tr ul".split())
REGIONS = set("article blockquote body center details dialog div dl fieldset figure html main ol section table ul".split())
# Regions that are a part of a text, never a whole one.
PARTS = set("blockquote center details dl fieldset figure ol section table ul".split())
PAGE_TAGS = set("aside menu nav".split())
PAGE_NAMES = set("banner complementary contentinfo footer header masthead menu menubar nav navbar navigation sidebar toolbar "
                 "topbar".split())
PAGE_LEVELS = {"", "html", "body"}
SPACES = {"br", "td", "th", "wbr"}
# An end tag may be left out; a new element of the list ends an open one.
IMPLIED_END = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
DROPPED = set("applet area aside audio button canvas datalist dialog embed footer form head header iframe input math menu nav "
              "noembed noframes noscript object optgroup option output progress script search select style svg template "
              "textarea title video".split())
DROPPED_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                    "status toolbar".split())
DROPPED_NAMES = set(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs captcha comment comments "
    "commentlist consent cookie cookies copyright disclaimer discussion disqus dropdown footer gdpr header login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager paginate pagination paywall popup "
    "promo promoted promotion recommendations recommended related replies reply respond responses search share sharing "
    "sidebar signin signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split())
NOT_A_PART = set("has no with without".split())
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*").findall
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I).search

# Of these names no element is looked through, however much text it holds.
NEVER_THROUGH = set("comment comments commentlist discussion disqus replies reply respond responses related recommended "
                    "recommendations nav navbar navigation menu footer".split())
THROUGH_TAGS = {"form"}
HEADINGS = set("h1 h2 h3".split())
MAX_WRAPPERS = 8
LEAST_KEPT = 0.1

SIGMA = 1.5
THRESHOLD = 0.6
REGION_SHARE = 0.95


def is_dropped(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """True if an element's role is not the article's text."""
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN_STYLE(value):
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in NAME_PARTS(word)]
                if not NOT_A_PART.intersection(parts[:1]) and DROPPED_NAMES.intersection(parts):
                    return True
    return False


def is_wrapper(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """True if a dropped element is dropped for a name, or is a form, so that it may be looked through."""
    if tag in DROPPED and tag not in THROUGH_TAGS:
        return False
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN_STYLE(value) or name == "role":
            return False
        if name in ("class", "id") and any(NEVER_THROUGH.intersection(p.lower() for p in NAME_PARTS(word)) for word in value.split()):
            return False
    return True


def is_of_page(tag: str, attrs: list[tuple[str, str | None]], region: str) -> bool:
    """True if a dropped element in a region of that name is the page's, not a part of an article."""
    if tag in PAGE_TAGS or tag in ("header", "footer") and region in PAGE_LEVELS:
        return True
    parts = (p.lower() for name, value in attrs if name in ("class", "id", "role") for p in NAME_PARTS(value or ""))
    return tag not in ("header", "footer") and not PAGE_NAMES.isdisjoint(parts)


class Lines(HTMLParser):
    """Collects a page's lines: text, tags, characters in links, links, region, whether dropped.

    ``regions`` has the regions' element names, ``heads`` and ``of_page`` the headings and the page's
    dropped elements right in them."""

    def __init__(self, through: frozenset[int] = frozenset()):
        """``through``: the numbers of the start tags whose elements are looked through."""
        super().__init__(convert_charrefs=True)
        self.through, self.n_start = through, 0
        # Elements that may be looked through, by the number of their start tag: [holds an article or
        # main, holds an h1, characters, of these in links].
        self.wrappers: dict[int, list] = {}
        self.kept_heads = 0
        self.lines: list[tuple[str, int, int, int, int, bool]] = []
        self.parents = [-1]
        self.regions, self.heads, self.of_page = [""], [0], [0]
        # Element, region, how it is dropped (0 not, 1 as a whole, 2 but for its headings), its wrapper.
        self.stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]
        self.text: list[str] = []
        self.tags = self.link_chars = self.links = self.in_link = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            tag, region, dropped, wrapper = self.stack[-1]
            self.lines.append((text, self.tags, self.link_chars, self.links, region, bool(dropped)))
            if wrapper:
                self.wrappers[wrapper][2] += len(text)
                self.wrappers[wrapper][3] += self.link_chars
            elif tag == "h1" and not dropped:
                self.kept_heads += 1
        if text or self.text:
            self.text, self.tags, self.link_chars, self.links = [], 0, 0, 0

    def handle_starttag(self, tag, attrs):
        self.n_start += 1
        top, region, dropped, wrapper = self.stack[-1]
        if top in IMPLIED_END and tag in IMPLIED_END[top]:
            self.end_line()
            self.stack.pop()
            top, region, dropped, wrapper = self.stack[-1]
        if tag in BLOCKS:
            self.end_line()
        elif tag in SPACES:
            self.text.append(" ")
        self.tags += 1
        if tag == "a":
            self.in_link += 1
            self.links += 1
        if tag in VOID:
            return
        if wrapper:
            self.wrappers[wrapper][0] |= tag in ("article", "main")
            self.wrappers[wrapper][1] |= tag == "h1"
        drop = dropped
        if dropped != 1 and self.n_start not in self.through and is_dropped(tag, attrs):
            drop = 2 if tag == "header" and not dropped and self.in_article(region) else 1
        elif dropped == 2 and tag in HEADINGS:
            drop = 0
        if drop and not dropped:
            self.end_line()
            self.of_page[region] += is_of_page(tag, attrs, self.regions[region])
            if drop == 1 and is_wrapper(tag, attrs):
                wrapper = self.n_start
                self.wrappers[wrapper] = [tag in ("article", "main"), False, 0, 0]
        if tag in REGIONS and not drop:
            self.parents.append(region)
            self.regions.append(tag)
            self.heads.append(0)
            self.of_page.append(0)
            region = len(self.parents) - 1
        if tag in ("h1", "h2") and not drop:
            self.heads[region] += 1
        if drop or tag in BLOCKS:
            self.stack.append((tag, region, drop, wrapper))

    def in_article(self, region: int) -> bool:
        while region > 0:
            if self.regions[region] == "article":
                return True
            region = self.parents[region]
        return False

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        elif tag in SPACES:
            self.text.append(" ")
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                self.end_line()
                del self.stack[depth:]
                return
        if tag in BLOCKS:
            self.end_line()

    def handle_data(self, data):
        self.text.append(data)
        if self.in_link:
            self.link_chars += len("".join(data.split()))


def around(page: Lines, region: int) -> list[int]:
    """A region and those it is in, the innermost first."""
    found = []
    while region >= 0:
        found.append(region)
        region = page.parents[region]
    return found


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """The ratios under a Gaussian kernel, which is cut off and normalised at the ends."""
    reach = math.ceil(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    middle = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def widened(best: int, page: Lines) -> int:
    """The region of the whole text that region ``best`` is a part of."""
    outer = around(page, best)
    heads, of_page = list(page.heads), list(page.of_page)
    for region in range(len(page.parents) - 1, 0, -1):
        heads[page.parents[region]] += heads[region]
        of_page[page.parents[region]] += of_page[region]
    articles = [r for r in outer if page.regions[r] == "article"]
    mains = [r for r in outer if page.regions[r] == "main"]
    if articles and (heads[articles[-1]] or not mains or not heads[mains[-1]]):
        return articles[-1]
    if mains:
        return mains[-1]
    at = next((i for i, r in enumerate(outer) if page.regions[r] not in PARTS))
    at = next((i for i in range(at, len(outer)) if heads[outer[i]]), at)
    while at + 1 < len(outer) and of_page[outer[at + 1]] == of_page[outer[at]]:
        at += 1
    return outer[at]


def main_region(lines: list[tuple], page: Lines) -> set[int]:
    """The regions inside the widened deepest one that holds REGION_SHARE of the content clusters' characters."""
    parents = page.parents
    size = np.array([len(line[0]) for line in lines], float)
    ratio = smoothed(size / np.maximum(1, [line[1] for line in lines]))
    content = ratio >= THRESHOLD * ratio.std()
    inside = np.zeros(len(parents))
    for line, n in zip(lines, np.where(content, size, 0), strict=True):
        region = line[4]
        while region >= 0:
            inside[region] += n
            region = parents[region]
    # Parents come before their children, so the last region that holds enough is the deepest.
    best = widened(int(np.flatnonzero(inside >= REGION_SHARE * inside[0])[-1]), page)
    found = {best}
    for region, parent in enumerate(parents):
        if parent in found:
            found.add(region)
    return found


def parsed(html: str, through: frozenset[int]) -> Lines:
    parser = Lines(through)
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser


def wrapper_of_article(page: Lines) -> int | None:
    """The dropped element that the article seems to be in, if what is kept has none."""
    found = {n: w for n, w in page.wrappers.items() if w[2] and 2 * w[3] < w[2]}
    if not found:
        return None
    kept = [line for line in page.lines if not line[5]]
    chars = sum(len(line[0]) for line in kept)
    whole = chars + sum(w[2] for w in page.wrappers.values())
    own = [line for line in kept if any(page.regions[r] in ("article", "main") for r in around(page, line[4]))]
    if chars >= LEAST_KEPT * whole and (own or page.kept_heads):
        return None
    best = max(found, key=lambda n: (found[n][0], found[n][1], found[n][2]))
    holds, head, size, _ = found[best]
    if holds and not own or head and not own and not page.kept_heads or chars < LEAST_KEPT * whole and 2 * size > whole:
        return best
    return None


def extract(html: str) -> str:
    """The main text of a page."""
    parser = parsed(html, frozenset())
    for _ in range(MAX_WRAPPERS):
        wrapper = wrapper_of_article(parser)
        if wrapper is None:
            break
        parser = parsed(html, parser.through | {wrapper})
    lines = [line for line in parser.lines if not line[5]]
    lines = [x for x in lines if not (x[3] > 1 and x[2] >= len(x[0].replace(" ", "")))]
    if not lines:
        return ""
    region = main_region(lines, parser)
    return "\n\n".join(line[0] for line in lines if line[4] in region)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars``."""
    return append_columns(pages, {"text": "string", "n_chars": "long"},
                          lambda: lambda htmls: ((t, len(t)) for t in map(extract, htmls)), column="html")
