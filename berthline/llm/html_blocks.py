"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one a block element.  Text lengths are summed over
a sliding window of lines; the sum surges where running text begins and dives
where it ends, and the text between is kept.  Lines of menus, forms, adverts,
comments and the like weigh nothing: they are gaps, and where nothing else
follows the sum dives.  Where no sum surges, the largest one is the text.
Where the page marks its article and most running text stands in it, lines of
the article have weight added, less than a surge takes, and beside it only long
running text surges.  Otherwise the marks count for nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import workers_import_package

WINDOW = 3              # lines of a block sum
SURGE = 80              # characters of a block sum at which text begins
BESIDE = 4              # times as many beside a marked article
ADDED = 3               # times as many are added to the weight of its lines

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr nobr img picture source br".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold no text of the page wherever they stand.
_TEXTLESS = frozenset(
    "title script style noscript template svg math iframe object canvas audio video select option textarea".split())
# Elements that hold no text of the article, unless they are wrapped round it.
_DROPPED = frozenset("head nav aside footer form button fieldset dialog menu map".split())
# Words that name such parts: a class or id does if all its words stand here or in _NEUTRAL,
# and one of them here.  Headers inside an article hold its title.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "sidebar sidebars aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer comment "
    "comments commentlist disqus replies respond share sharing social related recommended recommendations toolbar "
    "pagination pager login search masthead paywall".split())
# Names that say what a paragraph is, not only where it stands or what it is about.
_PARAGRAPH_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted cookie cookies consent "
    "gdpr notice notices newsletter subscribe subscription breadcrumb breadcrumbs disqus respond pagination "
    "paywall".split())
_REPLIES = frozenset("comment comments commentlist disqus replies respond".split())
_NEUTRAL = frozenset(
    "site page main post posts article articles entry entries item items list box block body area bar section container "
    "wrapper wrap inner outer top bottom left right primary secondary global header content link links button buttons "
    "icon icons form field thread group text title 1 2 3".split())
_HEADER_MARKS = frozenset(("header", "topbar"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Ids of other elements are anchors, which take their words from the text.
_NAMED_BY_ID = frozenset("div section ul ol dl table header details center".split())
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"))
_CLOSED_BY = {          # end tags that HTML lets an author leave out
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                   "hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "option": frozenset(("option", "optgroup")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr"))}
_SPLIT = re.compile(r"[^a-z0-9]+")


def _named(value: str, marks: frozenset) -> bool:
    """Whether a whole class or id of `value` names a part by `marks`."""
    for token in value.lower().split():
        words = set(filter(None, _SPLIT.split(token)))
        if words & marks and words <= marks | _MARKS | _NEUTRAL:
            return True
    return False


def _is_dropped(tag: str, attrs: list, in_article: bool) -> bool:
    if tag in _DROPPED:
        return True
    if tag == "header" and not in_article:
        return True
    for name, value in attrs:
        if name in ("class", "id") and value and tag not in ("html", "body", "main"):
            if name == "id" and (tag not in _NAMED_BY_ID or (
                    tag == "section" and in_article and not _named(value, _REPLIES))):
                continue
            if tag in _HEADINGS and in_article:
                continue
            if _named(value, _PARAGRAPH_MARKS if tag == "p" else _MARKS) or (not in_article and _named(value, _HEADER_MARKS)):
                return True
        elif name == "role" and value and value.lower() in _ROLES:
            return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
    return False


def _are_replies(attrs: list) -> bool:
    return any(name in ("class", "id") and value and _named(value, _REPLIES) for name, value in attrs)


class _Lines(HTMLParser):
    """Collects lines as (text, link characters, in article); a dropped part leaves a gap (None).

    Which parts are dropped is known when the page has been read: a part that is wrapped
    round the article, or round most of the running text, stays."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list = []           # text (None: a gap), link characters, part, article
        self.parts_seen: list[list] = []    # part above (-1: none), replies
        self.articles: list[list] = []      # article above (-1: none), part it stands in
        self.stack: list[tuple[str, bool, int, int]] = []     # tag, textless here or above, part, article
        self.at: dict[str, list[int]] = {}      # depths of the open elements of a tag
        self.blocks: list[int] = []             # depths of the open elements that are not inline
        self.closed: list[int] = []             # of those, the ones besides p
        self.parts: list[str] = []
        self.links = 0
        self.searched, self.last_end = -1, -1

    def _state(self) -> tuple[bool, int, int]:
        return self.stack[-1][1:] if self.stack else (False, -1, -1)

    def _depth(self, tag: str) -> int:
        """Depth of the innermost open element of a tag; -1: none."""
        return self.at[tag][-1] if self.at.get(tag) else -1

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.links, *self._state()[1:]))
        self.parts, self.links = [], 0

    def _push(self, tag: str, textless: bool, part: int, article: int) -> None:
        depth = len(self.stack)
        self.at.setdefault(tag, []).append(depth)
        if tag not in _INLINE:
            self.blocks.append(depth)
            if tag != "p":
                self.closed.append(depth)
        self.stack.append((tag, textless, part, article))

    def _pop(self, depth: int) -> None:
        """Close all elements from `depth` on."""
        if self.blocks and self.blocks[-1] >= depth:
            self._end_line()
        for tag, *_ in self.stack[depth:]:
            self.at[tag].pop()
        for depths in (self.blocks, self.closed):
            while depths and depths[-1] >= depth:
                depths.pop()
        del self.stack[depth:]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
            return
        # the innermost paragraph above the nearest other block, or that block itself, may end here
        near = self.closed[-1] if self.closed else -1
        for depth in (self._depth("p"), near):
            if depth >= max(near, 0) and tag in _CLOSED_BY.get(self.stack[depth][0], ()):
                self._pop(depth)
                break
        textless, part, article = self._state()
        if tag not in _INLINE:
            self._end_line()
        if tag in _TEXTLESS:
            self._end_line()
            self.lines.append((None, 0, part, article))
            textless = True
        if not textless and _is_dropped(tag, attrs, article >= 0):
            self._end_line()
            self.parts_seen.append([part, _are_replies(attrs)])
            part = len(self.parts_seen) - 1
            self.lines.append((None, 0, part, article))
        if tag in ("article", "main") and not textless:
            self.articles.append([article, part])
            article = len(self.articles) - 1
        if tag not in _VOID:
            self._push(tag, textless, part, article)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append(" ")
            return
        depth = self._depth(tag)
        if tag in _INLINE:                              # a stray inline end tag closes no block
            border = self.blocks[-1] if self.blocks else -1
        elif tag in ("body", "html", "article", "main"):
            border = -1
        else:
            border = max(map(self._depth, ("article", "main", "body")))
        if depth >= 0 and depth >= border:
            self._pop(depth)

    def handle_data(self, data):
        if not self._state()[0]:
            self.parts.append(data)
            if self.at.get("a"):
                self.links += len(data.strip())

    def parse_marked_section(self, i, report=1):
        """Sections in brackets hold no text: `<![CDATA[..]]>` to its end, any other as far as the
        next `>`, as browsers do; one that does not end is cut off."""
        close = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        end = self.rawdata.find(close, i)
        return end + len(close) if end >= 0 else -1

    def parse_comment(self, i, report=True):
        """A comment that does not end takes the rest of the page, as in browsers."""
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def check_for_whole_start_tag(self, i):
        # after the last `>` no tag ends: one search for all of them
        if len(self.rawdata) != self.searched:
            self.searched, self.last_end = len(self.rawdata), self.rawdata.rfind(">")
        return super().check_for_whole_start_tag(i) if i < self.last_end else -1

    def _stays(self) -> list[bool]:
        """Of every part that could be dropped, whether it stays."""
        above = [up for up, _ in self.parts_seen]
        running, own = [0] * len(above), [0] * len(self.articles)
        whole = 0
        for text, links, part, article in self.lines:
            if text:
                n = max(0, len(text) - links)
                whole += n
                if part >= 0:
                    running[part] += n
                if article >= 0 and part == self.articles[article][1]:
                    own[article] += n               # text of dropped parts is none of the article's
        for part in range(len(above) - 1, -1, -1):  # a part comes after the one above it
            if above[part] >= 0:
                running[above[part]] += running[part]
        for article in range(len(own) - 1, -1, -1):
            if self.articles[article][0] >= 0:
                own[self.articles[article][0]] += own[article]
        outermost = [i for i, (up, _) in enumerate(self.articles) if up < 0 and own[i]]
        free = [i for i in outermost if self.articles[i][1] < 0]
        stays = [False] * len(above)
        if not free and outermost:      # the article is wrapped in parts: they stay
            part = self.articles[max(outermost, key=lambda i: (own[i], -i))][1]
            while part >= 0:
                stays[part] = True
                part = above[part]
        for part, (up, replies) in enumerate(self.parts_seen):
            # beside an article of the page it takes more to be the main text; replies never are
            if not (replies and running[part] < whole) and running[part] * (4 if free else 2) > whole * (3 if free else 1):
                stays[part] = True
        return stays

    def done(self) -> list:
        self._end_line()
        stays = self._stays()
        gone = []
        for part, (up, _) in enumerate(self.parts_seen):
            gone.append(not stays[part] or (up >= 0 and gone[up]))
        lines = []
        for text, links, part, article in self.lines:
            if part >= 0 and gone[part]:
                if lines and lines[-1] is not None:
                    lines.append(None)
            elif text:
                lines.append((text, links, article >= 0))
            elif not (part >= 0 and stays[part]):
                lines.append(None)
        return lines


def block_sums(weights: list[int], window: int) -> list[int]:
    """Of every line, the weight of it and the window - 1 lines after."""
    sums, total = [0] * len(weights), 0
    for i in range(len(weights) - 1, -1, -1):
        total += weights[i] - (weights[i + window] if i + window < len(weights) else 0)
        sums[i] = total
    return sums


def kept_spans(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Line ranges [from, to) between surge and dive points.

    Text surges at the first line with weight whose block sum reaches `surge`, and
    dives at the first line after it whose block sum is nothing."""
    spans, i, n, sums = [], 0, len(weights), block_sums(weights, window)
    while i < n:
        if weights[i] and sums[i] >= surge:
            end = i
            while end < n and sums[end]:
                end += 1
            spans.append((i, end))
            i = end
        i += 1
    return spans


def _runs(marks: list[bool]) -> Iterator[tuple[int, int]]:
    start = None
    for i, mark in enumerate([*marks, False]):
        if mark and start is None:
            start = i
        elif not mark and start is not None:
            yield start, i
            start = None


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Text of the article; empty for null, empty and textless pages."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines, inside = [], None    # no block sum reaches over gaps, or over where the article begins or ends
    for x in parser.done():
        if x:
            if inside not in (None, x[2]):
                lines += [None] * window
            inside = x[2]
        lines += [x] if x else [None] * window
    # lines that are mostly links are menus, but for the article's
    plain = [len(x[0]) if x and 2 * x[1] <= len(x[0]) else 0 for x in lines]
    running = [i for a, b in kept_spans(plain, window, surge) for i in range(a, b)]
    marked = sum(len(x[0]) for x in lines if x and x[2])
    if marked and marked >= sum(plain[i] for i in running if lines[i] and not lines[i][2]):
        weights = [len(x[0]) + ADDED * surge if x and x[2] else n for x, n in zip(lines, plain)]
        sums, high = block_sums(weights, window), BESIDE * surge
        spans = set(kept_spans(weights, window, high))
        # a stretch of the article in which no sum surges is kept from its largest one on
        for a, b in _runs([n > ADDED * surge for n in weights]):
            if max(sums[a:b]) < high and not any(x <= a < y for x, y in spans):
                spans.update((a + x, a + y) for x, y in kept_spans(weights[a:b], window, max(sums[a:b])))
        spans = sorted(spans)
    else:
        spans = kept_spans(plain, window, min(surge, max(block_sums(plain, window), default=0) or surge))
    return "\n".join(lines[i][0] for a, b in spans for i in range(a, b) if lines[i])


def text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def udf(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)
    return udf(html)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars (code points of the text).

    A null or empty page has an empty text.  Null and repeated ids and urls keep
    their rows.  Markup may be cut off or wrongly nested.  Other columns are
    not read.  An empty table gives an empty table."""
    workers_import_package(pages.sparkSession)
    found = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                         text_column(F.col(f"`{html_col}`")).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
