"""Main text of web pages: parser events, text-to-tag ratio, smoothing, clustering.

The standard library's streaming parser turns a page into lines, one per block of text, with the
number of tags that came with it.  The text-to-tag ratios are smoothed with a Gaussian; lines above a
threshold, together with their neighbours in the same container, form the content regions.  What lies
inside or between those containers (lists, quotes, tables, sections) belongs to them.  Parts that are named as menus, headers, adverts, comments and the like never count.  A page with an
``article`` or ``main`` element has its region marked already.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from firegrid.llm.common import map_batches

SIGMA = 1.0
# A line is content if its smoothed ratio reaches this share of the standard deviation of all lines.
THRESHOLD = 1.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "script style template noscript head title iframe object embed svg math canvas audio video select option button textarea "
    "form fieldset dialog nav menu aside footer".split()
)
REGIONS = frozenset("article main".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Names in class or id, in whole or between hyphens and underscores, that mark parts beside the article.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion promoted banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar header masthead footer foot sidebar sidebars "
    "aside widget widgets related recommended recommendations share sharing social cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay subscribe subscription newsletter signup login comment comments commentlist disqus replies respond reader "
    "discussion form search skip copyright legal disclaimer".split()
)
_NAME = re.compile(r"[^a-z0-9]+")
# Tags whose start ends an open paragraph or an open element of the same kind.
_ENDS_SELF = frozenset("p li dt dd option tr td th".split())


class Line:
    __slots__ = ("text", "tags", "region", "dropped", "container")

    def __init__(self, text: str, tags: int, region: int, dropped: bool, container: int):
        self.text, self.tags, self.region, self.dropped, self.container = text, tags, region, dropped, container


class _Lines(HTMLParser):
    """Collects the lines of a page; a stack of open elements knows what a line lies in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        # (tag, dropped, region, container) of open elements.
        self.stack: list[tuple[str, bool, int, int]] = []
        self.n = 0
        # Of each container: the one around it, and its tag with its class.
        self.around: dict[int, int] = {}
        self.kind: dict[int, tuple[str, str]] = {0: ("", "")}

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            _, dropped, region, container = self.stack[-1] if self.stack else ("", False, 0, 0)
            self.lines.append(Line(text, self.tags, region, dropped, container))
            self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.flush()
            self.imply_end(tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in DROPPED:
            self.flush()
        self.n += 1
        _, dropped, region, container = self.stack[-1] if self.stack else ("", False, 0, 0)
        if tag in BLOCK and tag not in ("p", "li", "tr", "td", "th", "dt", "dd") and tag not in HEADINGS:
            self.around[self.n] = container
            self.kind[self.n] = (tag, next((v or "" for k, v in attrs if k == "class"), ""))
            container = self.n
        if tag in REGIONS and not dropped:
            region = region or self.n
        self.stack.append((tag, dropped or self.is_dropped(tag, attrs, region), region, container))

    def is_dropped(self, tag: str, attrs: list[tuple[str, str | None]], region: int) -> bool:
        if tag in DROPPED or tag == "header" and not region:
            return True
        for name, value in attrs:
            v = (value or "").lower()
            if name == "hidden" or name == "aria-hidden" and v == "true" or name == "role" and v in DROPPED_ROLES:
                return True
            if name == "style" and "display:none" in v.replace(" ", ""):
                return True
            if name in ("class", "id") and tag not in ("html", "body", "article", "main") and not DROPPED_NAMES.isdisjoint(_NAME.split(v)):
                return True
        return False

    def imply_end(self, tag: str) -> None:
        """An open paragraph ends at the next block; list items, cells and rows end at their next sibling."""
        for i in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[i][0]
            if open_tag == "p" or open_tag == tag and tag in _ENDS_SELF:
                del self.stack[i:]
                return
            if open_tag in BLOCK:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK or tag in DROPPED:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if self.stack[i][0] in ("article", "main", "body", "html") and tag not in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def parsed(html: str | None) -> _Lines:
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser


def content_lines(page: _Lines, chosen: set[int]) -> list[Line]:
    """The lines not dropped that lie inside a chosen container, between two, or in a row of blocks of the same kind.

    Pages that give every paragraph a container of its own have several chosen ones of one kind side by
    side; the row goes on before the first and after the last of them.
    """
    whole = {c for c in chosen if page.kind[c][0] not in ("", "html", "body")}
    inside: dict[int, bool] = {}
    for c in {x.container for x in page.lines}:
        path = []
        while c not in inside and c not in whole and c in page.around:
            path.append(c)
            c = page.around[c]
        inside.update(dict.fromkeys([*path, c], c in whole or inside.get(c, False)))
    usable = [x for x in page.lines if not x.dropped]
    kept = [x.container in chosen or inside[x.container] for x in usable]
    if True not in kept:
        return []
    place = lambda c: (page.around.get(c), page.kind[c])
    rows = Counter(place(c) for c in whole)
    in_row = [rows[place(x.container)] > 1 for x in usable]
    first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
    while first and in_row[first - 1]:
        first -= 1
    while last + 1 < len(usable) and in_row[last + 1]:
        last += 1
    return usable[first:last + 1]


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    radius = math.ceil(2 * sigma)
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    total = sum(kernel)
    n = len(values)
    return [sum(w * values[i + k - radius] for k, w in enumerate(kernel) if 0 <= i + k - radius < n) / total for i in range(n)]


def main_text(html: str | None, sigma: float = SIGMA, threshold: float = THRESHOLD) -> str:
    """The article's blocks, one per line; '' for null, empty and textless pages."""
    page = parsed(html)
    lines = page.lines
    usable = [x for x in lines if not x.dropped]
    marked = [x for x in usable if x.region]
    if marked:
        return "\n".join(x.text for x in marked)
    if not usable:
        return ""
    ratios = smooth([len(x.text) / max(1, x.tags) if not x.dropped else 0.0 for x in lines], sigma)
    mean = sum(ratios) / len(ratios)
    limit = threshold * math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    chosen = {x.container for x, r in zip(lines, ratios) if not x.dropped and r >= limit}
    return "\n".join(x.text for x in content_lines(page, chosen))


def extract(pages: DataFrame, sigma: float = SIGMA, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of ``pages``.

    Null, empty and textless pages have an empty text.  Broken markup is read as far as it goes.
    Repeated rows stay repeated; other columns are ignored; an empty table gives an empty result.
    """
    id_kind = pages.schema["page_id"].dataType.simpleString()

    def run(cols: dict[str, list]) -> dict[str, list]:
        texts = [main_text(h, sigma, threshold) for h in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select("page_id", "url", "html"), run, f"page_id {id_kind}, url string, text string, n_chars bigint")
