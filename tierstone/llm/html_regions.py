"""Main text of web pages from parser events and smoothed text-to-tag ratios.

The standard library's parser streams over the page. Block-level tags cut the text into
lines; each line has the number of its characters and of the tags in it. The ratios of
the two, smoothed by a Gaussian over the neighbouring lines, are clustered by a threshold
(a share of their standard deviation): lines above it are content. A region, the article or
main element around a line or else its nearest div, section or body, is selected when it
holds content lines and its own ratio reaches the threshold. All lines of the selected
regions are kept, so short headings, list items and cells between paragraphs stay, and
headings in an outer element right before a selected region with them. Elements that
never hold main text (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
reader comments) are left out beforehand, by tag name or by the names in class, id, role.
A name counts as a whole: not when it only tells a state (``has-sidebar``,
``comments-open``), and never for articles and headings. An element named so that holds
the bulk of the page's dense text stays; one named for other text (adverts, reader comments)
only if no dense text is elsewhere. A form counts like a named element, so one around the
whole page keeps the text and loses its controls and labels.

Defined cases: a null or empty page gives the empty text; repeated pages give repeated
rows; unclosed tags end where an enclosing element ends; an unclosed script runs to the
end of the page; other columns play no part; an empty table gives no row.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FEED_CHARS = 1 << 16
SIGMA = 1.0
THRESHOLD = 0.5

# Tag names of the HTML standard by their role, and words that name page furniture (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
NEVER = frozenset(
    "script style noscript template head title svg math iframe object canvas audio video nav footer aside button "
    "select option textarea input label legend dialog menu".split()
)
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice alert popup modal overlay sidebar sidebars rail widget widgets menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer topbar masthead toolbar search login signup subscribe subscription newsletter share sharing "
    "social related recommended teaser comment comments commentlist disqus discussion reply replies respond response responses complementary "
    "contentinfo".split()
)
STATES = frozenset(
    "has have no not non without with is are open opened closed close enabled disabled on off active inactive hide hidden "
    "show shown count layout wrap wrapper container page free".split()
)
# Names that themes also give to elements around the whole page; the others name short or foreign text.
FORM = frozenset("form fieldset".split())
LAYOUT = FORM | frozenset("alert banner header login masthead modal notice overlay popup rail search sidebar sidebars social widget widgets".split())
# Words that are as likely the anchor of a chapter as the name of furniture.
ANCHORS = frozenset("ad alert banner consent discussion notice promotion related reply replies respond search share sharing social".split())
HEADED = frozenset("article content entry main post story text title".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img ins kbd mark q s samp small span strong sub sup time u var".split())
PAGE_HEADER = frozenset("header banner masthead".split())
REGION = frozenset("article main".split())
CONTAINER = REGION | frozenset("div section body td".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMING = frozenset("class id role".split())
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class RegionParser(HTMLParser):
    """Collects the lines of one page: text, number of tags, region, whether it is a heading, named element, characters in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int, int]] = []
        self.around: dict[int, int] = {}  # container to the one around it
        self.cells: set[int] = set()
        self.links = self.linked = 0
        self.open: list[tuple[str, bool, int, int, int]] = []  # tag, left out, region, container, named
        self.named: dict[int, tuple[int, bool]] = {}  # element named as furniture: the one around it, layout only
        self.ends: dict[int, int] = {}  # closed container to the last element in it
        self.parts: list[str] = []
        self.tags = self.count = 0

    def _state(self) -> tuple[bool, int, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, 0, 0)

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, region, container, named = self._state()
            self.lines.append((text, self.tags, region or container, bool(self.open) and self.open[-1][0] in HEADING, named, self.linked))
        self.parts.clear()
        self.tags = self.linked = 0

    def _furniture(self, tag: str, attrs: list, region: int) -> set[str]:
        """Words of furniture among the names of an element."""
        found = set()
        if tag in HEADING or tag in ("html", "body", "main", "article"):
            return found
        for name, value in attrs:
            for token in (value or "").split() if name in NAMING else ():
                words = set(WORD.findall(CAMEL.sub("-", token).lower()))
                if words & STATES or (name == "id" and tag == "section" and words <= ANCHORS):
                    continue
                found |= words & FURNITURE
                if not region and not words & HEADED:
                    found |= words & PAGE_HEADER
        return found

    def handle_starttag(self, tag, attrs):
        left_out, region, container, named = self._state()
        words = set() if left_out or tag in VOID else self._furniture(tag, attrs, region) | ({tag} & FORM)
        if tag in BLOCK or (words and tag not in INLINE):
            self._end_line()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag == "body":
            self.open.clear()  # an unclosed head ends here
            self.links = 0
        if tag in VOID:
            return
        if tag == "body":
            left_out, region, container, named = self._state()
        self.count += 1
        left_out = left_out or tag in NEVER or (tag == "header" and not region) or bool(words and tag in INLINE)
        left_out = left_out or (tag not in ("html", "body", "main") and any(name == "hidden" for name, _ in attrs))
        if words and not left_out:
            self.named[self.count] = named, words <= LAYOUT
            named = self.count
        if tag in REGION and not left_out and not region:
            region = self.count
        if tag in CONTAINER:
            self.around[self.count] = container
            if tag == "td":
                self.cells.add(self.count)
        self.links += tag == "a"
        self.open.append((tag, left_out, region, self.count if tag in CONTAINER else container, named))

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._end_line()
        self.tags += 1
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if self.open[at][4] != (self.open[at - 1][4] if at else 0):
                    self._end_line()
                self.ends.update((o[3], self.count) for o in self.open[at:] if o[0] in CONTAINER)
                self.links -= sum(o[0] == "a" for o in self.open[at:])
                del self.open[at:]
                return

    def handle_data(self, data):
        if not self._state()[0]:
            self.parts.append(data)
            self.linked += len(data.strip()) if self.links > 0 else 0

    def finish(self) -> list[tuple[str, int, int, bool, int, int]]:
        self.close()
        self._end_line()
        return self.lines


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def unnamed(lines: list[tuple[str, int, int, bool, int, int]], named: dict[int, tuple[int, bool]], sigma: float, share: float):
    """The lines outside elements named as furniture, or in one that holds the bulk of the dense text."""
    if not named:
        return lines
    ratios = smoothed(np.array([len(line[0]) / max(1, line[1]) for line in lines], float), sigma)
    least = min(share * ratios.std(), ratios.max())
    dense = dict.fromkeys([0, *named], 0)
    for line, ratio in zip(lines, ratios):
        dense[line[4]] += len(line[0]) if ratio >= least else 0
    for inner in reversed(named):  # elements around others come first
        dense[named[inner][0]] += dense[inner]
    stay = {0}
    for one, (around, layout) in named.items():
        if around in stay and dense[one] and 2 * dense[one] > dense[0] and (layout or dense[one] == dense[0]):
            stay.add(one)
    return [line for line in lines if line[4] in stay]


def content_regions(lines: list[tuple[str, int, int, bool, int, int]], sigma: float, share: float) -> set[int]:
    """Regions that hold a content line and whose own text-to-tag ratio is that of content."""
    ratios = smoothed(np.array([len(text) / max(1, tags) for text, tags, *_ in lines], float), sigma)
    least = min(share * ratios.std(), ratios.max())
    chars, tags, found = {}, {}, set()
    for (text, count, region, *_), ratio in zip(lines, ratios):
        chars[region] = chars.get(region, 0) + len(text)
        tags[region] = tags.get(region, 0) + count
        if ratio >= least:
            found.add(region)
    return {region for region in found if chars[region] >= least * max(1, tags[region])} or found


def main_text(html: str | None, sigma: float = SIGMA, share: float = THRESHOLD) -> str:
    if not html:
        return ""
    parser = RegionParser()
    for start in range(0, len(html), FEED_CHARS):
        parser.feed(html[start : start + FEED_CHARS])
    lines = unnamed(parser.finish(), parser.named, sigma, share)
    if not lines:
        return ""
    chosen = content_regions(lines, sigma, share)
    chosen |= _going_on(lines, chosen, parser)
    kept, below = [], 0
    for text, _, region, heading, *_ in reversed(lines):
        if region in chosen:
            below = region
        elif not (heading and region <= below <= parser.ends.get(region, parser.count)):
            below = -1
            continue
        kept.append(text)
    return "\n\n".join(reversed(kept))


def _going_on(lines: list[tuple[str, int, int, bool, int, int]], chosen: set[int], parser: RegionParser) -> set[int]:
    """Short regions inside the selected text: between two selected ones of one element, or cells of a selected region."""
    chars, linked = {}, {}
    for text, _, region, _, _, links in lines:
        chars[region] = chars.get(region, 0) + len(text)
        linked[region] = linked.get(region, 0) + links
    text_like = {r for r in chars if r not in chosen and 2 * linked[r] <= chars[r]}
    outer = parser.around.get
    found = {r for r in text_like & parser.cells if outer(r) in chosen}
    before, run = None, set()
    for region in [line[2] for line in lines]:
        if region not in chosen:
            run.add(region)
            continue
        if before is not None:
            # On both sides the selected region is the element around this one, or lies in it too.
            found |= {r for r in run & text_like if outer(r) in {before, outer(before, -1)} & {region, outer(region, -1)}}
        before, run = region, set()
    return found


def extract(pages: DataFrame, sigma: float = SIGMA, share: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches):
        for batch in batches:
            texts = [main_text(html.as_py(), sigma, share) for html in batch.column("html")]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
