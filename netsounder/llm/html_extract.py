"""Main text of web pages from streamed parser events and text-to-tag ratios.

The standard library's parser gives events; a line of the page is a block of
text between block-level tags. Each line's ratio of characters to tags, 0 where
its markup says that it is a menu, header, footer, sidebar, notice, advert, form
or comment, is smoothed by a Gaussian over its neighbours, and lines above the
deviation of all ratios form the content clusters. The deepest element that
holds most of the clusters' text is the content region. Tags only settle what the
ratios leave open: an article around or among the clusters gives the region its
bounds. All blocks of a region are the article, short ones too; in a page
without any inner region that is from the first cluster to the last.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
RADIUS = 2
#: Share of the clusters' characters that the content region holds at least.
HELD = 0.9
#: Share of them by which one article among several is the page's.
MAIN = 0.5

_SILENT = frozenset("script style noscript template head title iframe object svg canvas select option datalist textarea button audio video map".split())
_BOILER = frozenset("nav footer aside form menu dialog".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that never hold a region, so that leaving them open does no harm.
_LOOSE = frozenset("p li dt dd td th tr option h1 h2 h3 h4 h5 h6 hr br".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMES = re.compile(
    r"(?<![a-z])(?:ad|ads|adv|advert|adverts|advertisement|advertising|adsense|adslot|sponsor|sponsored|promo|promotion|banner|"
    r"cookie|cookies|consent|gdpr|notice|notices|notification|alert|popup|modal|nav|navbar|navigation|menu|menus|"
    r"breadcrumb|breadcrumbs|header|masthead|footer|sidebar|sidebars|rail|comment|comments|respond|replies|disqus|"
    r"share|sharing|social|related|recommended|newsletter|subscribe|subscription|signup|login|search|pagination|pager|toolbar|"
    r"copyright)(?![a-z])"
)
_TALK = re.compile(r"(?<![a-z])(?:comment|comments|respond|replies|disqus)(?![a-z])")
_INLINE_NAMES = re.compile(r"(?<![a-z])(?:ad|ads|advert|advertisement|sponsor|sponsored|promo|share|social)(?![a-z])")
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())


class _Node:
    __slots__ = ("boiler", "named", "parent", "region", "silent", "tag", "talk", "whole")

    def __init__(self, tag: str, parent: _Node | None, attrs: list) -> None:
        self.tag, self.parent = tag, parent
        given = dict(attrs)
        label = f"{given.get('class') or ''} {given.get('id') or ''}"
        role = (given.get("role") or "").lower()
        self.region = tag in ("article", "main") or role == "main" or (given.get("itemprop") or "") == "articleBody"
        inside = parent is not None and parent.whole
        self.whole = inside or self.region
        hidden = "hidden" in given or (given.get("aria-hidden") or "") == "true"
        self.silent = (parent is not None and parent.silent) or tag in _SILENT
        self.boiler = tag in _BOILER or (tag == "header" and not inside) or role in _ROLES or hidden
        self.named = self.talk = False
        if tag not in ("body", "html") and label != " ":
            label = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", label).lower()
            self.named, self.talk = _NAMES.search(label) is not None, _TALK.search(label) is not None
        if self.named and self.region:
            self.region = tag == "main"

    def above(self) -> Iterator[_Node]:
        node: _Node | None = self
        while node is not None:
            yield node
            node = node.parent


class _Events(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = self.root = _Node("html", None, [])
        self.loud = 0
        self.blocks: list[tuple[_Node, str, int, int, bool]] = []
        self.headed: set[_Node] = set()
        self.holding: set[_Node] = set()
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.in_link = self.heading = False

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.open, text, max(1, self.tags), self.linked, self.heading))
            self.parts = []
        self.tags = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _INLINE:
            self.tags += 1
            if tag == "a":
                self.in_link = True
            if not (attrs and tag not in _VOID and _INLINE_NAMES.search(str(dict(attrs).get("class") or "").lower())):
                return
        self.end_block()
        self.tags += 1
        if tag in _VOID:
            return
        self.heading = tag in _HEADINGS
        if tag not in _INLINE:
            self._close(tag if tag in _LOOSE else "p", within=True)
        if tag == "h1":
            self.headed.update(self.open.above())
        elif tag in ("article", "main"):
            self.holding.update(self.open.above())
        if tag in _LOOSE and not attrs:
            return
        self.open = _Node(tag, self.open, attrs)

    def _close(self, tag: str, within: bool = False) -> None:
        node = self.open
        while node is not None and node.tag != tag:
            if within and node.tag not in _LOOSE and node.tag not in _INLINE:
                return
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in _INLINE:
            self.tags += 1
            if self.open.tag == tag:
                self.end_block()
                self.open = self.open.parent
            return
        self.end_block()
        self.heading = False
        self.tags += 1
        if tag not in ("body", "html"):
            self._close(tag, within=tag in _LOOSE)

    def handle_data(self, data: str) -> None:
        if not self.open.silent:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)


_KERNEL = np.array([math.exp(-(k**2) / (2 * SIGMA**2)) for k in range(-RADIUS, RADIUS + 1)])
_KERNEL /= _KERNEL.sum()


def content_lines(ratio: np.ndarray) -> np.ndarray:
    """Lines of the clusters: smoothed text-to-tag ratio at or above the ratios' deviation."""
    smooth = np.convolve(np.pad(ratio, RADIUS, mode="edge"), _KERNEL, mode="valid")
    return smooth >= min(ratio.std(), smooth.max())


def _in_list(bare: list[bool], k: int) -> bool:
    """Whether ``k`` is one of three or more lines in a row that are links alone."""
    return any(0 <= i and i + 3 <= len(bare) and all(bare[i : i + 3]) for i in (k - 2, k - 1, k))


def main_text(html: str | None) -> str:
    """The article's text: references decoded, white space single, blocks joined by a space; "" if there is none."""
    if not html:
        return ""
    events = _Events()
    for at in range(0, len(html), 1 << 20):
        events.feed(html[at : at + (1 << 20)])
    events.close()
    events.end_block()
    away: dict[_Node, bool] = {}

    def outside(node: _Node | None) -> bool:
        trail = []
        while node is not None and node not in away:
            trail.append(node)
            node = node.parent
        found = node is not None and away[node]
        for n in reversed(trail):
            found = found or n.boiler or (n.named and n not in events.headed and (n.talk or n not in events.holding))
            away[n] = found
        return found

    blocks = events.blocks
    inner = np.array([not outside(b[0]) for b in blocks], bool)
    if not inner.any():
        return ""
    own = np.array([len(b[1]) - min(len(b[1]), b[3]) for b in blocks], np.float64)
    chosen = content_lines(np.where(inner, own / np.array([b[2] for b in blocks]), 0.0)) & inner
    best = _region(blocks, own, chosen) or events.root
    kept = inner & np.array([any(n is best for n in b[0].above()) for b in blocks])
    if best.tag in ("html", "body") and chosen.any():
        kept &= _span(blocks, chosen)
    bare = [not c and not best.region and b[3] >= 0.9 * len(b[1]) for b, c, k in zip(blocks, chosen, kept, strict=True) if k]
    return " ".join(blocks[i][1] for k, i in enumerate(np.flatnonzero(kept)) if not _in_list(bare, k))


def _region(blocks: list, own: np.ndarray, chosen: np.ndarray) -> _Node | None:
    """The deepest element that holds the clusters' text, or the article that bounds it."""
    held: dict[_Node, float] = {}
    deep: dict[_Node, int] = {}
    for k in np.flatnonzero(chosen):
        line = list(blocks[k][0].above())
        for i, up in enumerate(line):
            held[up] = held.get(up, 0.0) + own[k]
            deep[up] = len(line) - i
    total = float(own[chosen].sum())
    best = max((n for n in held if held[n] >= HELD * total), key=lambda n: (deep[n], held[n]), default=None)
    if best is None:
        return None
    around = [n for n in best.above() if n.region]
    among = [n for n in held if n.region and held[n] >= MAIN * total]
    if around:
        return around[-1]
    if among:
        return min(among, key=lambda n: deep[n])
    return next((n for n in best.above() if n.tag not in _LOOSE and n.tag not in _INLINE), best)


def _span(blocks: list, chosen: np.ndarray) -> np.ndarray:
    """From the first cluster, with the headings right before it, to the last."""
    at = np.flatnonzero(chosen)
    lo, hi = int(at[0]), int(at[-1]) + 1
    while lo and blocks[lo - 1][4]:
        lo -= 1
    out = np.zeros(len(blocks), bool)
    out[lo:hi] = True
    return out


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of each row of ``pages(page_id, url, html)``.

    Null and empty pages have empty text; broken markup is read as far as it
    goes; repeated rows each come back; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
