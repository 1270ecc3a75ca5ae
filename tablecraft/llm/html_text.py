"""Main text of web pages from parser events, text-to-tag ratios and clustering.

The standard library's parser streams through the page; every block becomes a line with its text, the
number of tags in it and the containers around it. Lines inside elements that are never content
(menus, scripts, forms, ...) or are block containers named like furniture (``class="ad"``) are left out. The ratios of
text to tags of the other lines are smoothed with a Gaussian, split into two clusters at a threshold,
and the high cluster says where the content is: the region is the smallest container that holds all
clustered lines. All lines of the region belong to the text, short ones too. Where ``article`` or
``main`` elements hold most of the clustered text, the page itself says where its content is: then only
the clustered lines in them count, and the region is the smallest such element that holds all of these,
or else all such elements that hold some.

Defined results: null or empty pages, and pages without text, give an empty text; unclosed and stray
tags are closed by their surroundings, and an excluded element that was left open also by a start tag that
cannot be inside it, such as ``article`` in ``nav`` or ``p`` in ``button``; character references are decoded as
browsers do. Every page is one value and is read as a whole, in time and memory that grow with its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea svg math iframe object canvas audio video dialog menu".split()
)
HEADERS = frozenset(["header"])
REGIONS = ("article", "main")
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# Elements that hold a piece of text: their names say what the text is about, not that it is furniture.
PIECES = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd th caption figcaption blockquote pre address legend summary".split())
# Words in class, id and role that name furniture.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "sidebar comment comments disqus respond reply replies nav navbar navigation menu breadcrumb breadcrumbs footer masthead share sharing social related "
    "recommended newsletter subscribe subscription signup login popup modal overlay toolbar pagination pager skip widget complementary contentinfo search".split()
)
PAGE_HEADER = frozenset("header topbar".split())
PAGE = frozenset("site page global top main".split())  # may stand beside those
# Words that may stand beside furniture: ``main-menu`` is furniture, ``search-methods`` is not.
BESIDE = frozenset(
    "main top bottom left right side site page global primary secondary user reader bar box list item items link links button buttons icon icons media "
    "area wrapper wrap container block panel form section widget slot unit inner outer post posts articles story stories content more".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Start tags that cannot be inside an excluded element: there it was left open.
ENDED_BY = {
    **dict.fromkeys(("nav", "header", "footer", "menu", "dialog"), frozenset(REGIONS)),
    **dict.fromkeys(("aside", "form"), frozenset(["main"])),
    **dict.fromkeys(("button", "select", "option"), frozenset(("p", "section", "nav", "header", "footer", "aside", *REGIONS)) | _HEADINGS),
    "head": frozenset(("body", "header", "nav", "p", "section", *REGIONS)) | _HEADINGS,
}
BODIES = frozenset(("html", "body", "div", "section", "center", *REGIONS))  # what can be a region
MOST = 0.6  # share of the clustered text that article and main must hold to be believed
WIDTH = 1.0  # standard deviation of the smoothing, in lines
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Lines(HTMLParser):
    """Collects ``(text, tags, container)`` of every line outside excluded elements. Containers are numbered
    in the order of their start tags; ``parents`` and ``names`` tell about each. Every tag takes the same time,
    however many elements are open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []
        self.names: list[str] = ["html"]  # by container number
        self.parents: list[int] = [-1]
        self.open: list[tuple[str, int, int]] = []  # element, container number, how many that are not inline up to it
        self.places: dict[str, list[int]] = {}  # of the open elements, by name
        self.inner = 0  # the innermost open container
        self.off = 0  # depth of the outermost excluded element, 0 for none
        self.parts: list[str] = []
        self.tags = 1

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.tags, self.inner))
        self.parts, self.tags = [], 1

    def _excluded(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        inside = any(self.places.get(name) for name in REGIONS)
        if tag in NEVER or (tag in HEADERS and not inside):
            return True
        if tag in PIECES or tag in ("html", "body", *REGIONS):
            return False
        telling = ("class", "role") if inside else ("class", "id", "role")  # ids in an article are slugs of its titles
        for name in " ".join(v for k, v in attrs if k in telling and v).split():
            words = {w.lower() for w in _NAME.findall(name)}
            if words & FURNITURE and words <= FURNITURE | BESIDE:
                return True
            if not inside and words & PAGE_HEADER and words <= PAGE_HEADER | PAGE:
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.off and tag in ENDED_BY.get(self.open[self.off - 1][0], ()):
            self._cut(self.off - 1)  # left open: this cannot be inside it
        if tag in CLOSES_P:
            self._close("p")
        if tag == "br":
            self.parts.append(" ")
        if tag not in INLINE and tag != "br":
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        number = -1
        if not self.off and self._excluded(tag, attrs):
            self.off = len(self.open) + 1
        elif tag not in INLINE:
            number = len(self.names)
            self.names.append(tag)
            self.parents.append(self.inner)
            self.inner = number
        blocks = (self.open[-1][2] if self.open else 0) + (tag not in INLINE)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, number, blocks))

    def _close(self, tag: str) -> None:
        at = self.places[tag][-1] if self.places.get(tag) else None
        if at is None or (tag == "p" and self.open[-1][2] > self.open[at][2]):
            return
        self._cut(at)

    def _cut(self, at: int) -> None:
        """Close the open elements from a place on."""
        if self.open[-1][2] > (self.open[at - 1][2] if at else 0):
            self._end_line()
        for name, number, _ in reversed(self.open[at:]):
            self.places[name].pop()
            if number >= 0:
                self.inner = self.parents[number]
        del self.open[at:]
        if self.off > len(self.open):
            self.off = 0
            self.parts = []

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag not in VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.off:
            self.parts.append(data)

    def finish(self) -> None:
        self.close()
        self._end_line()


def _smoothed(values: list[float]) -> list[float]:
    reach = math.ceil(2 * WIDTH)
    kernel = [math.exp(-(d * d) / (2 * WIDTH * WIDTH)) for d in range(-reach, reach + 1)]
    total, last = sum(kernel), len(values) - 1
    return [sum(k * values[min(max(i + d, 0), last)] for d, k in zip(range(-reach, reach + 1), kernel)) / total for i in range(len(values))]


def _threshold(values: list[float]) -> float:
    """Border between two clusters of numbers, found from their means in turn."""
    low, high = min(values), max(values)
    border = (low + high) / 2
    for _ in range(20):
        below, above = [v for v in values if v < border], [v for v in values if v >= border]
        if not below or not above:
            break
        moved = (sum(below) / len(below) + sum(above) / len(above)) / 2
        if moved == border:
            break
        border = moved
    return border


def main_text(html: str | None) -> str:
    """The main text of one page."""
    reader = _Lines()
    reader.feed(html or "")
    reader.finish()
    lines = reader.lines
    if not lines:
        return ""
    ratios = _smoothed([len(text) / tags for text, tags, _ in lines])
    border = _threshold(ratios)
    clustered = [(len(text), at) for (text, _, at), ratio in zip(lines, ratios) if ratio >= border]
    clustered = clustered or [(len(text), at) for text, _, at in lines]
    in_named = _inherited(reader.parents, [name in REGIONS for name in reader.names])
    named = [(n, at) for n, at in clustered if in_named[at]]
    if sum(n for n, _ in named) >= MOST * sum(n for n, _ in clustered):
        clustered, may = named, frozenset(REGIONS)
    else:
        may = BODIES
    shared = _common(reader.parents, min(at for _, at in clustered), max(at for _, at in clustered))
    while shared >= 0 and reader.names[shared] not in may:
        shared = reader.parents[shared]
    if shared >= 0:
        regions = {shared}
    else:
        inside = _inherited(reader.parents, [name in may for name in reader.names])
        outermost = {k for k, parent in enumerate(reader.parents) if inside[k] and not (parent >= 0 and inside[parent])}
        holding = _inherited(reader.parents, [k if k in outermost else 0 for k in range(len(reader.names))])
        regions = {holding[at] for _, at in clustered}
    kept = _inherited(reader.parents, [k in regions for k in range(len(reader.names))])
    return " ".join(text for text, _, at in lines if kept[at])


def _inherited(parents: list[int], own: list) -> list:
    """For every container what it has itself, or else what its parent has."""
    held: list = []
    for parent, mine in zip(parents, own):
        held.append(mine or (held[parent] if parent >= 0 else mine))
    return held


def _common(parents: list[int], first: int, last: int) -> int:
    """The innermost container that holds two others, and all that are numbered between them and lie in either."""
    while first != last:
        if first > last:
            first = parents[first]
        else:
            last = parents[last]
    return first


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("__html")]
        rest = [c for c in batch.schema.names if c != "__html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())], names=[*rest, "text"])


def extract(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """The columns ``keep`` and ``text``, one row per page. One pass, nothing shuffles."""
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*keep, F.col(html).alias("__html")).mapInArrow(_extract, f"{kinds}, text string")
