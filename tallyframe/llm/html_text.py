"""HTML extraction: text-to-tag ratio per line, smoothed and thresholded to content regions."""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrow import Step, map_texts
from tallyframe.llm.common import text_of

#: width of the Gaussian in lines
SIGMA = 1.0
#: a line with more than this share of its text in links is a list of links
LINK_SHARE = 0.6

# What HTML says about its elements, and names that pages give to what is not the article. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
REGIONS = frozenset("article aside body div footer form header main nav ol section table td ul".split())
#: what stands in prose as part of it
FLOW = frozenset("ol table td ul".split())
#: elements that end where the next of the same tag begins
UNNESTED = frozenset("li option p td".split())
DROPPED = frozenset(
    "aside audio button canvas dialog embed footer form head iframe input map menu nav noscript object option script "
    "select style svg template textarea title video".split()
)
MAIN = frozenset(("article", "main"))
DROPPED_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adsbox advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie "
    "cookies consent disclaimer disqus dropdown footer footnav gdpr header hidden infobar login masthead menu menus modal "
    "nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promotion recommended "
    "related reply replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe "
    "subscription tags toolbar topbar warning widget widgets".split()
)
# names of several words, in one piece
DROPPED_NAMES |= frozenset(
    "adbanner adbox adcontainer adslot adunit adwrapper commentform commentsarea commentsection cookiebanner cookiebar "
    "cookieconsent cookienotice entrytags globalfooter globalheader leftsidebar loginform mainmenu mainnav mainnavigation "
    "navmenu newslettersignup posttags recommendedposts relatedarticles relatedcontent relatedlinks relatedposts "
    "relatedstories rightsidebar searchbar searchbox searchform sharebar sharebuttons sharelinks sidebarleft sidebarright "
    "navlinks sidemenu sidenav signupform sitefooter siteheader sitenav sitenavigation skiplink skipnav socialicons sociallinks "
    "socialmedia socialshare socialsharing subnav tagcloud taglist topmenu topnav widgetarea".split()
)
# parts of longer names that tell reader comments and adverts, and parts with which a name tells of a state instead
TELLING_PARTS = frozenset("advert advertisement advertorial comment comments disqus sponsored".split())
STATE_PARTS = frozenset("closed disabled enabled has hide no off on open show with without".split())
#: names that stand for parts of the text inside an article
KEPT_INSIDE = frozenset("disclaimer header notice notices warning".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _dropped_by(tag: str, attributes: dict[str, str | None], in_main: bool) -> str:
    """Why an element is left out: its tag (or role), hidden, its name, or empty if it is not.

    Names are whole words of class and the whole id, without hyphens and underscores; those of comments and adverts
    may also be a part between these, unless another part says that the name is of a state (``has-comments``).
    """
    if tag in ("html", "body"):
        return ""
    if tag == "form":
        return "name"
    if tag in DROPPED or tag == "header" and not in_main:
        return "tag"
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style") or ""):
        return "hidden"
    if tag in MAIN:
        return ""
    if (attributes.get("role") or "").lower() in DROPPED_ROLES:
        return "tag"
    words = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".lower()
    names = DROPPED_NAMES.intersection(words.replace("-", "").replace("_", "").split())
    if names - KEPT_INSIDE or names and not in_main:
        return "name"
    parts = [set(re.split("[-_]+", word)) for word in words.split()]
    return "name" if any(p & TELLING_PARTS and not p & STATE_PARTS for p in parts) else ""


class Drop:
    """An open or closed element that is to be left out, with the one around it.

    ``main`` is how many article or main elements were open at its start. Lines in up to ``limit`` of them are left out.
    """

    __slots__ = ("around", "why", "main", "closed", "size", "holds_main", "limit", "firm")

    def __init__(self, around: Drop | None, why: str, main: int) -> None:
        self.around, self.why, self.main, self.closed = around, why, main, False
        self.size, self.holds_main, self.limit, self.firm = 0, False, -1, -1


class Region:
    """A section-like element: its cluster, and the clusters of the regions in it by tag and class.

    ``box`` is the tag and class of the innermost element around it with a class, inside an article or main element.
    """

    __slots__ = ("tag", "cluster", "last", "inner", "box")

    def __init__(self, tag: str, cluster: int, box: tuple[str, str] | None = None) -> None:
        self.tag, self.cluster, self.last, self.inner, self.box = tag, cluster, None, {}, box


class LineReader(HTMLParser):
    """Lines of a page, from the parser's events as they come.

    A line ends where a block element begins or ends. Each has its text, the number of tags on it, the characters in
    links, the cluster of its region (the innermost open section-like element), its box (see ``Region``), whether it
    lies in the article or main element, and whether it is an h1. Neighbours of one parent with the same tag and class are one cluster, and so are regions at the same
    place in these. A list or table without a class belongs to the text around it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple] = []
        self._all: list[tuple[tuple, int, Drop]] = []
        self.boxes = Counter()
        self._ended = False
        self._text: list[str] = []
        self._tags = self._linked = self._links = self._main = 0
        # open section-like or dropped elements with what is around each, and how many there are of each tag
        self._region, self._open, self._count = Region("", 0), [], Counter()
        self._clusters, self._series = 1, {}
        self._title = False
        self._drop = Drop(None, "", 0)
        self._drops = [self._drop]

    def _end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            region = self._region
            line = (text, self._tags, self._linked, region.cluster, region.box, self._main > 0, self._title)
            self._all.append((line, self._main, self._drop))
            self._tags = 0
        self._text, self._linked = [], 0

    def _enter(self, tag: str, attributes: dict[str, str | None], why: str) -> None:
        """Open a section-like or dropped element."""
        name = " ".join((attributes.get("class") or "").split())
        around, key = self._region, (tag, name)
        self._open.append((tag, around, self._drop, (self._tags, self._links) if why else None))
        self._count[tag] += 1
        self._main += tag in MAIN
        if tag in MAIN and self._drop.around:
            self._tags = self._links = 0
        if why:
            self._drop = Drop(self._drop, why, self._main)
            self._drops.append(self._drop)
        if tag not in REGIONS or tag in FLOW and not name and around.tag not in ("", "body", "table"):
            return
        if key != around.last:
            first = (around.cluster, key)
            if key in around.inner or first not in self._series:
                self._series.setdefault(first, self._clusters)
                around.inner[key] = self._clusters
                self._clusters += 1
            else:
                around.inner[key] = self._series[first]
            around.last = key
        box = around.box
        if name and self._main and tag not in MAIN and tag not in FLOW:
            box = key
            self.boxes[key] += 1
        self._region = Region(tag, around.inner[key], box if tag not in MAIN else None)

    def _leave(self, tag: str) -> bool:
        """Close the innermost open element of this tag, and those in it that were never closed; whether one was dropped."""
        dropped = False
        while self._count[tag]:
            last, self._region, drop, before = self._open.pop()
            if before:
                self._drop.closed = last == tag
                self._tags, self._links = before
                dropped = True
            self._drop = drop
            self._count[last] -= 1
            self._main -= last in MAIN
            if last == tag:
                break
        return dropped

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCKS:
            self._end_line()
            self._title = tag == "h1" or self._title and tag in VOID
        last = self._open[-1][0] if self._open else ""
        if last == "p" and tag in BLOCKS or last == tag and tag in UNNESTED:
            self._leave(last)  # its end tag may be left out
        if tag in VOID:
            self._tags += 1
            return
        attributes = dict(attrs)
        why = _dropped_by(tag, attributes, self._main > 0)
        if why:
            self._end_line()
        if why or tag in REGIONS or self._count[tag]:
            self._enter(tag, attributes, why)
        if not why:
            self._tags += 1
            self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            if tag in BLOCKS:
                self._end_line()
            self._tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or self._count[tag] and self._drop.around:
            self._end_line()
            self._title = False
        if self._leave(tag):
            return
        self._tags += 1
        if tag == "a":
            self._links = max(0, self._links - 1)

    def handle_data(self, data: str) -> None:
        if self._open and self._open[-1][0] in ("script", "style"):
            return
        self._text.append(data)
        if self._links:
            self._linked += len(data.strip())

    def parse_comment(self, i: int, report: int = 1) -> int:
        """A comment that is never closed takes the rest of the page with it."""
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 and self._ended else end

    def _limits(self) -> None:
        """Up to how many open article or main elements lines are left out; what was never closed ends at the next one."""
        for drop in self._drops[1:]:
            own = math.inf if drop.closed else drop.main
            drop.firm = max(drop.around.firm, own if drop.why == "tag" else -1)
            drop.limit = max(drop.around.limit, own if drop.why else -1)

    def close(self) -> None:
        """The lines that no drop leaves out.

        If no article or main element is among them, an element is not dropped by its name if it holds most of the text,
        and not as hidden if it holds an article or main besides.
        """
        self._ended = True
        super().close()
        self._end_line()
        self._limits()
        if not any(main > max(0, drop.limit) for _, main, drop in self._all):
            total = 0
            for (text, *_), main, drop in self._all:
                if main > drop.firm:
                    total += len(text)
                    drop.size += len(text)
                    drop.holds_main |= main > 0
            for drop in reversed(self._drops[1:]):
                drop.around.size += drop.size
                drop.around.holds_main |= drop.holds_main
                if drop.size * 2 > total and (drop.why == "name" or drop.why == "hidden" and drop.holds_main):
                    drop.why = ""
            self._limits()
        self.lines = [line for line, main, drop in self._all if main > drop.limit]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; beyond the ends there is nothing to share with."""
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weights


def main_text(html: str) -> str:
    """The article's text, its blocks joined by single spaces.

    Clusters of regions whose smoothed text-to-tag ratio, the mean over their characters, reaches the threshold, the
    standard deviation of all lines, are content; their short lines come with them, but lists of links need the
    threshold themselves. If some of the content lies in an article or main element, only what lies there counts, and
    there less is left out: its lines all stay but for those in elements with a class of their own whose ratio, the
    mean over all elements of that tag and class, is below the threshold before or after the smoothing, and which come
    more than once (teasers, adverts) or are links.
    """
    last = html.rfind(">") + 1
    cut = re.compile("<[A-Za-z/!?]").search(html, last)
    reader = LineReader()
    reader.feed(html[: cut.start()] if cut else html)  # without a tag that the end of the page cuts off
    reader.close()
    lines = reader.lines
    if not lines:
        return ""
    sizes = np.array([len(t) for t, *_ in lines], float)
    own = sizes / np.array([max(1, tags) for _, tags, *_ in lines])
    ratios = smoothed(own)
    clusters = np.array([line[3] for line in lines])
    inside = np.array([line[5] for line in lines])
    titles = np.array([line[6] for line in lines])
    linked = np.array([n for _, _, n, *_ in lines]) > LINK_SHARE * sizes
    threshold = float(np.std(ratios))
    means = np.bincount(clusters, ratios * sizes) / np.maximum(1, np.bincount(clusters, sizes))
    content = (means >= min(threshold, means.max()))[clusters] & (~linked | (ratios >= threshold))
    if (content & inside).any():
        numbers = {box: i for i, box in enumerate(dict.fromkeys(line[4] for line in lines))}
        boxes = np.array([numbers[line[4]] for line in lines])
        # a box of a line or two gets its neighbours' ratio from the smoothing, so its own counts as well
        low = np.bincount(boxes, np.minimum(own, ratios) * sizes) / np.maximum(1, np.bincount(boxes, sizes)) < threshold
        repeated = np.array([reader.boxes[box] > 1 for box in numbers])
        boxed = np.array([box is not None for box in numbers])
        aside = (low & boxed)[boxes] & (repeated[boxes] | linked)
        content = inside & (titles | ~aside)
    return " ".join(line[0] for line, kept in zip(lines, content, strict=True) if kept)


def _extracted() -> Step:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )

    return step


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page, from its whole html.

    One pass of parser events per page; nothing is shuffled, and a page's memory is its own size. Broken markup is
    read as the parser reads it: an element that is never closed ends with the one around it, but a dropped one at
    the latest where the article begins. Articles in a dropped element that is closed go with it.

    Null and empty html give empty texts, as do pages without text. Null ids and repeated rows pass through. An
    empty table gives no rows. Other columns are not read, whatever their names.

    Columns: page_id, url, text.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"
    return map_texts(rows.withColumn("url", F.col("url").cast("string")), _extracted, schema, text_col="html")
