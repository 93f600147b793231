"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

Each page is read once as a stream of standard-library parser events, which become lines (one for each block
of text) with their number of tags and their place in the page. The text-to-tag ratios of the lines are
smoothed with a Gaussian kernel and cut at a threshold found by two-means clustering. The content region is the
article around the container of nearly all text above the threshold, with the articles beside it that are not mostly
links; or the main element, if a title or lead stands in it before that article or there is none. Without either, it is
the smallest container of all such text, and the containers around it as long as they add no page frame and no line
that is mostly links. Every line in the region is kept, short ones too; of a header in an article, its headings.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are known by their tags,
roles and class names and never take part. A name that says so for sure (``comments``, ``ad-slot``, ``site-notice``)
leaves its box out unless an article lies inside it or it holds most of the page; comments that come after an article
stay out even with articles inside. A name that may mean body text, too (``related``, ``legal``, an id ``login``), leaves
out boxes that are mostly links, and short ones that are neither a section nor a heading; a name that only contains such
a word (``with-sidebar``) only boxes that are mostly links. A page that would come out empty by its class names alone
is read without them.

Null and empty html give an empty text. A page without markup is one line and is kept. Repeated pages get equal
results. Text outside the page's elements counts as part of the body. Malformed declarations are comments. Time grows
with the page, however deep its elements lie in each other. Columns of the input are not touched:
``extract`` reads the columns it is told to and returns its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: fixed values: tags whose content is never article text
SILENT = frozenset("head title script style noscript template svg math iframe object embed canvas audio video select option button textarea input label fieldset form nav header footer aside menu dialog".split())
#: fixed values: tags that begin a new block of text
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: fixed values: tags without content
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: fixed values: words in class, id or role that mark what surrounds an article
NOISE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar rail widget related recommended recommendations trending share sharing social comment comments commentlist reply replies respond discussion disqus header masthead footer colophon copyright legal toc search skip contentinfo complementary".split())
#: fixed values: those of them that name body text, too, or a box around it; ids, often anchors of a section, do so more often
DOUBTFUL = frozenset("header search toc widget legal related discussion rail complementary".split())
ANCHORS = frozenset("notice banner overlay respond reply replies copyright skip pager notification alert modal popup share sharing social subscription signup login consent gdpr promotion recommended recommendations trending masthead sponsor sponsored".split())
#: fixed values: those that stand on single words of a sentence, too
SPOKEN = frozenset("notice banner overlay respond reply replies copyright skip pager".split())
SURE = {"class": NOISE - DOUBTFUL, "id": NOISE - DOUBTFUL - ANCHORS, "role": NOISE, "inline": NOISE - DOUBTFUL - SPOKEN}
#: fixed values: words around body text as often as around anything else, so the size of their boxes says nothing
COMMON = frozenset(("header", "widget"))
#: fixed values: first words of names that say how a box is laid out or filed, not what it is, and where it is
LAYOUT = frozenset("has with without no hide show is layout col row wrap wrapper container category tag type format status".split())
PLACE = frozenset("content page main body article post entry".split())
SITE = frozenset("site global top".split())
#: fixed values: words for what readers add, which may be longer than the article
READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
WHOLE = frozenset(("html", "body", "main", "article"))
SPLIT = re.compile(r"[^a-z0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: fixed values: tags that frame a page, so what holds one is more than the article
FRAME = frozenset("nav header footer aside menu".split())
CORE_SHARE = 0.9  # the article or main element around this share of the text above the threshold is the region
MOST = 0.75  # a box with this share of the page's text is no sidebar
SHORT, LITTLE = 500, 0.25  # a box of fewer characters, with less than this share of the page's text, is short
LINKED = 0.5  # a line or box with this share of its text in links is no prose
SIGMA = 1.0


#: why a box is left out: not at all; if it is mostly links; if it is mostly links or short; by its name (an article
#: inside undoes these three); by its tag
KEEP, IF_LINKS, IF_SHORT, NAMED, GONE = range(5)


class _Box:
    """An open element. ``level``: why it is left out. ``readers``: its name says that readers added it. ``heads``: of
    what lies in it, only headings are shown."""

    __slots__ = ("tag", "level", "up", "depth", "weight", "frame", "shown", "size", "linked", "readers", "heads")

    def __init__(self, tag: str, level: int, up: _Box | None, readers: bool = False, heads: bool = False):
        self.tag, self.level, self.up, self.readers, self.heads = tag, level, up, readers, heads
        self.size = self.linked = 0
        self.depth = up.depth + 1 if up else 0
        self.weight, self.frame, self.shown = 0.0, int(tag in FRAME), False

    def show(self, shown: bool) -> None:
        """Decide whether its own lines are shown, after the box around it; shown: nothing is said against it."""
        up = self.up
        if not shown:
            self.shown = self.heads = False
        elif self.heads:  # a header of an article
            self.shown, self.heads = False, up.shown
        else:
            self.heads = up is not None and up.heads and self.tag not in HEADINGS
            self.shown = not self.heads and (up is None or up.shown or up.heads)


@lru_cache(50_000)
def _named(kind: str, value: str) -> tuple[int, bool]:
    """What a class, id or role (kind) says: a level, and whether it names what readers add."""
    level, readers = KEEP, False
    for name in value.split():
        words = [w for w in SPLIT.split(CAMEL.sub("-", name).lower()) if w]
        if NOISE.isdisjoint(words):
            continue
        ends = {words[0], words[-1]}
        if words[0] in LAYOUT:
            found = IF_LINKS
        elif words[0] in PLACE:
            found = NAMED if words[-1] in READERS else IF_SHORT if words[-1] in NOISE - COMMON else IF_LINKS
        elif ends & SURE[kind]:
            found = NAMED
        elif ends & (NOISE - COMMON) or (words[-1] == "header" and (words[0] in SITE or (kind == "id" and len(words) == 1))):
            found = IF_SHORT
        else:
            found = IF_LINKS
        level, readers = max(level, found), readers or (found == NAMED and not READERS.isdisjoint(words))
    return level, readers


class _Lines(HTMLParser):
    """Parser events to lines: (text, tags, box, whether most of it is links)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = _Box("#page", 0, None)
        self.box = self.top
        self.boxes = [self.top]  # in page order, so a box comes after the one around it
        self.open: Counter[str] = Counter()
        self.articles = 0
        self.lines: list[tuple[str, int, _Box, bool]] = []
        self.parts: list[str] = []
        self.link, self.linked, self.said = False, 0, 0
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.box, self.linked >= LINKED * self.said))
            self.tags = 0
        self.parts, self.linked, self.said = [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "a":
            self.link = any(name == "href" for name, _ in attrs)
        block = tag in BLOCK
        if block:
            self.end_line()
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        heads = tag == "header" and self.open["article"] + self.open["main"] > 0
        level, readers = GONE if tag in SILENT and not heads else KEEP, False
        for name, value in attrs if level < GONE and tag not in ("html", "body") else ():
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and HIDDEN.search(value)):
                level = GONE if tag not in WHOLE else level
            elif name in ("class", "id", "role") and value and not (name == "id" and tag in HEADINGS):
                by_name, by_readers = _named(name if block or name != "class" else "inline", value)
                if tag in WHOLE:  # only what readers add may be left out
                    by_name = NAMED if by_readers and tag == "article" and self.articles else KEEP
                elif by_name == IF_SHORT and (tag == "section" or tag in HEADINGS or (name == "id" and tag == "p")):
                    by_name = IF_LINKS
                elif not block:
                    by_name = GONE if by_name == NAMED else KEEP  # an inline box can't hold an article
                level, readers = max(level, by_name), readers or (by_readers and by_name >= NAMED)
        if readers and self.articles:
            level = GONE  # comments come after what they are about
        self.articles += tag == "article"
        if level or heads or (block and tag != "p"):
            self.box = _Box(tag, level, self.box, readers, heads)
            self.boxes.append(self.box)
            self.open[tag] += 1
            if tag in ("article", "main") and not readers:
                up = self.box.up
                while up:
                    up.level = KEEP if up.level <= NAMED else up.level
                    up = up.up if up.tag not in ("article", "main") else None  # that one saw to what is around it

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in BLOCK or tag in SILENT:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.link = False
        if tag in BLOCK:
            self.end_line()
        if not self.open[tag]:
            return
        box = self.box
        while box.up and box.tag != tag:
            if box.tag in SILENT and box.tag != tag and tag not in WHOLE and tag not in SILENT:
                return  # an end tag inside a form or menu does not close what is around it
            box = box.up
        if box.up:
            while self.box is not box.up:
                self.open[self.box.tag] -= 1
                self.box = self.box.up

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # a section of no known kind
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        if self.box.level < GONE:
            self.parts.append(data)
            size = len(data.strip())
            self.said += size
            self.linked += size if self.link else 0
            self.box.size += size
            self.box.linked += size if self.link else 0


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends the nearest value goes on."""
    reach = max(1, int(round(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """The cut between the lower and the upper of two clusters of the values."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        upper = values >= cut
        if upper.all() or not upper.any():
            break
        a, b = float(values[~upper].mean()), float(values[upper].mean())
        if (a, b) == (low, high):
            break
        low, high = a, b
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The main text of one page; empty for null, empty and all-boilerplate pages."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.end_line()
    for box in reversed(page.boxes):
        if box.up:
            box.up.size += box.size
            box.up.linked += box.linked
    for box in page.boxes:
        links = box.linked > LINKED * box.size
        if box.level in (IF_LINKS, IF_SHORT):
            short = box.size < SHORT and box.size < LITTLE * page.top.size
            box.level = NAMED if links or (box.level == IF_SHORT and short) else KEEP
        elif box.level == NAMED and not box.readers and not links and box.size >= MOST * page.top.size:
            box.level = KEEP
    heads = {id(box) for box in page.boxes if box.heads}
    for box in page.boxes:
        box.show(not box.level)
    lines = [line for line in page.lines if line[2].shown]
    if not lines:  # nothing but tags left out, or class names were wrong
        for box in page.boxes:
            box.heads = id(box) in heads
            box.show(box.level < GONE and not box.readers)
        lines = [line for line in page.lines if line[2].shown]
    if not lines:
        return ""
    sizes = np.array([len(text) for text, _, _, _ in lines], dtype=float)
    smoothed = smooth(sizes / np.maximum(1, [tags for _, tags, _, _ in lines]))
    chosen = smoothed >= threshold(smoothed)
    for (_, _, box, linked), size, above in zip(lines, sizes.tolist(), chosen.tolist(), strict=True):
        if above:
            box.weight += size
        box.frame += linked
    for box in reversed(page.boxes):
        if box.up:
            box.up.weight += box.weight
            box.up.frame += box.frame
    region, article = _region(page.boxes, sizes[chosen].sum(), lines)
    chosen_boxes, inner = _within(page.boxes, region), _within(page.boxes, [article] if article else region)
    # in the main element around an article, lines that are mostly links are no part of it
    return "\n\n".join(text for text, _, box, linked in lines if id(box) in chosen_boxes and (not linked or id(box) in inner))


def _within(boxes: list[_Box], arounds: list[_Box]) -> set[int]:
    """The identities of these boxes and all in them; boxes come after the ones around them."""
    found = {id(box) for box in arounds}
    for box in boxes:
        if id(box.up) in found:
            found.add(id(box))
    return found


def _region(boxes: list[_Box], total: float, lines: list[tuple[str, int, _Box, bool]]) -> tuple[list[_Box], _Box | None]:
    """The boxes of the article (total: the weight of all text above the threshold), and where that is a main element
    around one, the article in it."""
    around: dict[str, _Box] = {}
    box = max((b for b in boxes if b.weight and b.weight >= CORE_SHARE * total), key=lambda b: b.depth)
    while box:
        if box.tag in ("article", "main"):
            around[box.tag] = box  # the outermost
        box = box.up
    article, main = around.get("article"), around.get("main")
    if article:
        if main and main.depth < article.depth:
            inner, outer = _within(boxes, [article]), _within(boxes, [main])
            for _, _, box, linked in lines:
                if id(box) in inner:
                    break
                if not linked and id(box) in outer:
                    return [main], article
        beside = [b for b in boxes if b.tag == "article" and b.up is article.up and b.shown and b.linked <= LINKED * b.size]
        return [article, *beside], None
    if main:
        return [main], None
    region = max((b for b in boxes if b.weight >= total), key=lambda b: b.depth)
    while region.up and (region.tag in _LEAVES or region.up.frame == region.frame):
        region = region.up
    return [region], None


#: boxes that hold a part of an article, never all of it
_LEAVES = frozenset("h1 h2 h3 h4 h5 h6 li ul ol dl dd dt blockquote pre td th tr tbody thead tfoot table caption figcaption figure address summary details hgroup".split())


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, text and n_chars (code points) of each page."""
    for name in ("text", "n_chars"):
        if name in keep:
            raise ValueError(f"a kept column is called {name}, like a result")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(x) for x in batch.pop("_html")]
            yield batch.assign(text=texts, n_chars=np.array([len(x) for x in texts], dtype=np.int64))

    source = pages.select(*keep, pages[html].cast("string").alias("_html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInPandas(run, f"{kinds}, text string, n_chars bigint")
