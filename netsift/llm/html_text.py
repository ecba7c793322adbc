"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into blocks (a text between
two tags of block elements) with the number of tags in each and the elements around it.
A block's ratio is its text outside links over its tags; blocks in elements that hold no article
(menus, footers, forms, by tag, role, or words of their class and id) have
ratio 0. Words and ``form`` are only a sign: they exclude no heading, nothing by its id inside an ``article``, and no element that
holds most of the page's text outside links or the article itself. The smoothed ratios are split at their standard deviation (never
above their mean): runs above it are content regions. The regions vote, by their text, for
the element that holds the article: the innermost ``article`` or ``main`` with most of what these hold, or
else the smallest element with most of the regions' text. Of an ``article`` or ``main`` every block
stays that is not in such an excluded element; of another element those that are not mostly links; of the body those
from the first region to the last and headings before them.

White space in a block becomes one space, ``br`` counts as white space, blocks are joined by a
newline. What begins a tag, comment or declaration and is not closed ends with the page: a start tag that has no quote or
equals sign counts as text, anything else goes, as in browsers. Every step is one pass over the page or its elements, so that
broken or deeply nested pages take time in proportion to their length. Defined results: a null, empty or tagless-blank page has an empty text; text without any tag is one block; unclosed
and stray tags are tolerated; rows are handled one by one, so repeats and null ids do not matter; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser, locatestarttagend_tolerant

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
MOST = 0.8
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form head header "
    "hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("head title script style noscript template svg annotation annotation-xml canvas iframe object video audio select datalist option textarea button".split())
#: What may stand in a head; anything else ends it, as its end tag may be left out.
HEAD = frozenset("base basefont bgsound link meta title script style noscript template".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
#: Words of a class or id that mark what is not the article; a name is split at anything but letters, and at capitals.
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs "
    "sidebar footer comment comments disqus replies respond cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget toolbar pagination pager skip".split()
)
#: Words that do so outside an article only, where they do not name its own title.
OUTER_WORDS = frozenset("header masthead topbar".split())
#: Words that mark even an ``article`` or ``main``, and what holds most of an article's text.
HARD_WORDS = frozenset("comment comments related sponsored promo ad".split())
#: Words that an id may have besides, where it names a part of the page and not a heading's text.
PLACES = frozenset("left right top bottom main primary secondary box container wrapper wrap inner outer area block list bar".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_VALUE = re.compile(r"""=*\s*(["'])""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """``out``: excluded, ``sign``: to be excluded unless it holds most of the page's text or the article, ``firm``: not for most of the text."""

    __slots__ = ("tag", "parent", "out", "article", "sign", "firm", "depth")

    def __init__(self, tag: str, parent: Element | None, out: bool, article: Element | None, sign: bool = False, firm: bool = False):
        self.tag, self.parent, self.out, self.article, self.sign, self.firm = tag, parent, out, article, sign, firm
        self.depth = 0 if parent is None else parent.depth + 1


class Muted:
    """The hidden elements that are open, with constant-time answers however many they are."""

    def __init__(self):
        self.tags: list[str] = []
        self.count: Counter[str] = Counter()
        self._first: dict[str, int] = {}

    def add(self, tag: str) -> None:
        self._first.setdefault(tag, len(self.tags))
        self.tags.append(tag)
        self.count[tag] += 1

    def clear(self) -> None:
        self.__init__()

    def only(self, tag: str) -> bool:
        return bool(self.tags) and self.count[tag] == len(self.tags)

    def end(self, tag: str) -> None:
        """Everything from the first such element on ends."""
        at = self._first[tag]
        while len(self.tags) > at:
            last = self.tags.pop()
            self.count[last] -= 1
            if not self.count[last]:
                del self.count[last], self._first[last]


class Blocks(HTMLParser):
    """Collects blocks: ``text, tags, link characters, element``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", None, False, None)
        self.blocks: list[tuple[str, int, int, Element]] = []
        self._text: list[str] = []
        self._tags = self._linked = self._links = 0
        self._mute = Muted()
        self._open: Counter[str] = Counter()
        self._signs = False
        self._elements: list[Element] = []

    def _end_block(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.blocks.append((text, self._tags, min(self._linked, len(text)), self.at))
            self._tags = 0
        self._text, self._linked = [], 0

    def _excluded(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if (tag in ASIDE and tag != "form") or (tag == "header" and self.at.article is None):
            return True
        for name, value in attrs:
            if name == "role" and value and value.lower() in ROLES and (tag, value.lower()) != ("form", "form"):
                return True
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return tag not in ("html", "body")
        return False

    def _words(self, tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
        """Words of the class and id that mark the element."""
        if tag in HEADINGS or tag in ("html", "body"):
            return set()
        inside, found = self.at.article, set()
        known = WORDS if inside is not None else WORDS | OUTER_WORDS
        for name, value in attrs:
            if name in ("class", "id") and value:
                for one in value.split() if name == "class" else [value] if inside is None or inside.tag != "article" else []:
                    words = {w.lower() for w in _NAMES.findall(one)}
                    if words <= known | PLACES:  # a name with other words in it is of something else
                        found |= words & known
        return found & HARD_WORDS if tag in ("article", "main") else found

    def _left_open(self, tag: str) -> None:
        """End a head or options, whose end tags may be left out, at a tag that cannot be in them."""
        if self._mute.count["head"] and (tag == "body" or self._mute.tags[-1] == "head" and tag not in HEAD):
            self._mute.clear()
        elif tag in BLOCKS and self._mute.only("option"):
            self._mute.clear()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        self._left_open(tag)
        if tag in HIDDEN:
            if tag in BLOCKS:
                self._end_block()
            self._mute.add(tag)
            return
        if self._mute.tags:
            return
        if tag == "br":
            self._text.append(" ")
        elif tag == "a":
            self._links += 1
        if tag not in BLOCKS:
            return
        self._end_block()
        if self.at.tag == "p" or self.at.tag == tag == "li" or (self.at.tag in ("td", "th") and tag in ("td", "th", "tr")):
            self._leave(self.at.parent)  # closed by what follows
        if tag not in VOID:
            out = self.at.out or self._excluded(tag, attrs)
            words = set() if out else self._words(tag, attrs)
            firm = self.at.article is not None and bool(words & HARD_WORDS)
            self.at = Element(tag, self.at, out, self.at.article, tag == "form" or bool(words), firm)
            self._elements.append(self.at)
            self._open[tag] += 1
            self._signs |= self.at.sign
            if tag in ("article", "main") and not out:
                self.at.article = self.at

    def _leave(self, to: Element) -> None:
        while self.at is not to:
            self._open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if self._mute.only("option"):
            self._left_open(tag)
        if self._mute.tags:
            if self._mute.count[tag]:
                self._mute.end(tag)
            elif tag in ("head", "body", "html") or self._mute.count["head"] and tag == "title":
                self._mute.clear()
            return
        if tag == "a":
            self._links = max(0, self._links - 1)
        if tag not in BLOCKS:
            return
        self._end_block()
        if self._open[tag]:
            e = self.at
            while e.tag != tag:
                e = e.parent
            self._leave(e.parent)
            self._links = 0

    def handle_data(self, data: str) -> None:
        if self._mute.tags == ["head"] and data.strip():
            self._mute.clear()
        if not self._mute.tags:
            self._text.append(data)
            if self._links:
                self._linked += len(data)

    # The page is fed whole, so what the parser finds unfinished (-1) is never closed: it is settled at once, not looked
    # for again from every sign behind it.

    def check_for_whole_start_tag(self, i: int) -> int:
        end = super().check_for_whole_start_tag(i)
        if end >= 0 and self.rawdata[end - 1] == ">":
            return end
        stop = locatestarttagend_tolerant.match(self.rawdata, i).end()
        value = _VALUE.match(self.rawdata, stop)
        if stop == len(self.rawdata) or value and self.rawdata.find(value[1], value.end()) < 0:
            return -1  # never closed
        return stop  # what is not like a tag becomes text, up to there

    def parse_starttag(self, i: int) -> int:
        end = super().parse_starttag(i)
        if end < 0:
            rest = self.rawdata[i:]
            if not any(c in rest for c in "\"'="):
                self.handle_data(rest)
            end = len(self.rawdata)
        return end

    def parse_endtag(self, i: int) -> int:
        end = super().parse_endtag(i)
        return end if end > 0 else len(self.rawdata)

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def parse_bogus_comment(self, i: int, report: bool = True) -> int:
        end = super().parse_bogus_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        end = super().parse_pi(i)
        return end if end >= 0 else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        end = super().parse_html_declaration(i)
        return end if end >= 0 else len(self.rawdata)

    def read(self, html: str) -> list[tuple[str, int, int, Element]]:
        self.feed(html)
        self.close()
        self._end_block()
        if self._signs:
            self._settle()
        return self.blocks

    def _settle(self) -> None:
        """Exclude elements by their signs, but not what holds most of the page's text outside links or the article."""
        held: dict[Element, int] = {}
        total = rest = 0
        for text, _, linked, e in self.blocks:
            n = len(text) - linked
            total += n
            if not e.out:
                rest += n
                held[e] = held.get(e, 0) + n
        add_up(held, self._elements)
        kept = set()
        articles = {e: n for e, n in held.items() if e.article is e and not e.sign}
        if articles:
            most = max(articles.values())
            best = max((e for e, n in articles.items() if n >= MOST * most), key=lambda e: e.depth)
            if 2 * held[best] >= rest:
                while best is not None:
                    kept.add(best)
                    best = best.parent
        for e in self._elements:  # parents come first
            much = held.get(e, 0) >= MOST * total and not e.firm
            e.out = e.out or e.parent.out or (e.sign and not much and e not in kept)


def add_up(held: dict[Element, int], elements: list[Element]) -> None:
    """Give every element the sum of what it and all below it hold; in ``elements`` parents come before children."""
    for e in reversed(elements):
        if e in held:
            held[e.parent] = held.get(e.parent, 0) + held[e]


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = math.ceil(3 * sigma)
    x = np.arange(-radius, radius + 1)
    kernel = np.exp(-(x**2) / (2 * sigma**2))
    return np.convolve(np.pad(ratio, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def content_regions(blocks: list[tuple[str, int, int, Element]]) -> np.ndarray:
    """Which blocks are in a content region, by the smoothed ratio or at its edge by their own."""
    ratio = np.array([0.0 if e.out else (len(t) - linked) / max(1, tags) for t, tags, linked, e in blocks])
    even = smoothed(ratio)
    least = min(even.std(), even.mean())
    return (np.maximum(even, ratio) >= least) & (ratio > 0)


def main_text(html: str | None) -> str:
    page = Blocks()
    blocks = page.read(html or "")
    if not blocks:
        return ""
    content = content_regions(blocks)
    chosen = np.flatnonzero(content)
    if not len(chosen):
        return ""
    votes: dict[Element, int] = {}
    for k in chosen:
        votes[blocks[k][3]] = votes.get(blocks[k][3], 0) + len(blocks[k][0])
    add_up(votes, page._elements)

    def within(best: Element) -> set[Element]:
        found = {best}
        for e in page._elements:
            if e.parent in found:
                found.add(e)
        return found

    articles = {a: n for a, n in votes.items() if a.article is a}
    if articles:
        most = max(articles.values())
        inner = within(max((a for a, n in articles.items() if n >= MOST * most), key=lambda e: e.depth))
        return "\n".join(t for t, _, _, e in blocks if not e.out and e in inner)
    total = sum(len(blocks[k][0]) for k in chosen)
    best = max((e for e, n in votes.items() if n >= MOST * total), key=lambda e: e.depth)
    if best.tag in HEADINGS or best.tag in ("p", "li", "td"):
        best = best.parent or best
    inner = within(best)
    inside = [k for k in range(len(blocks)) if not blocks[k][3].out and blocks[k][3] in inner]
    if best.tag not in ("body", "html", ""):  # an element of its own: all of it but lists of links
        return "\n".join(blocks[k][0] for k in inside if content[k] or 2 * blocks[k][2] < len(blocks[k][0]))
    marked = [k for k in inside if content[k]]
    first, last = marked[0], marked[-1]
    before = [k for k in inside if k < first]
    while before and blocks[before[-1]][3].tag in HEADINGS:
        first = before.pop()
    return "\n".join(blocks[k][0] for k in inside if first <= k <= last and (content[k] or 2 * blocks[k][2] < len(blocks[k][0])))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` per row."""
    rows = pages.select(F.struct(F.col(f"`{id_col}`").alias("a"), F.col(f"`{url_col}`").alias("b")).alias("o"), F.col(f"`{html_col}`").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(h.as_py()) for h in batch.column("h")]
            cols = [batch.column("o"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["o", "text", "n_chars"])

    shape = rows.schema["o"].dataType.simpleString()
    out = rows.mapInArrow(run, f"o {shape}, text string, n_chars bigint")
    return out.select(F.col("o.a").alias(id_col), F.col("o.b").alias(url_col), "text", "n_chars")
