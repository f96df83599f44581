"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's ``HTMLParser`` streams a page's events.  Block-level
tags cut its text into lines (blocks); each line has its text, its tags and its
element.  Elements that cannot hold article text (navigation, footers, scripts,
hidden parts) give lines of ratio zero.  Forms and elements whose class or id
names a part beside the article do so too, unless their text speaks against it:
such an element is a wrapper (``has-sidebar``, a form around the page) if it
holds at least half of the page's text and either an article or nearly all text
that no such name excludes; and a name of two meanings (``share``, ``widget``)
doesn't exclude a long text without links.  The text-to-tag ratios, without link text, are smoothed
by a Gaussian; lines above the standard deviation are content lines.  They
choose the content region on every page: the smallest element that holds all
of them, widened to the ``article`` or ``main`` element around it.  If they lie
in several articles and nowhere else, those articles are the region.  Every
line of the region outside the excluded elements is kept, however short.

A block's text has its character references decoded and each run of white
space (also ``<br>``) turned into one space; blocks are joined by newlines.
Defined cases: null, empty or text-free pages give an empty text; unclosed
elements end with their parent; a page without content lines keeps all its
lines outside excluded elements.  Nothing is cut off, however long, and time
and memory grow with the page, however deep it nests.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
EXCLUDED = frozenset(
    "aside audio button canvas datalist dialog embed footer head iframe input map menu nav noscript "
    "object option script select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                  "search toolbar".split())
#: Words of a class or id that name a part beside the article.
ASIDE = frozenset(
    "ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr hidden login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promoted promotion related share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
#: Of these, names that also stand in an article's own parts, and those of reader comments.
TWO_MEANINGS = frozenset("alert promotion share sharing social widget widgets".split())
READERS = frozenset("comment comments disqus".split())
#: Unlinked characters (and their part of the text) from which a name of two meanings is no reason.
LONG_TEXT, UNLINKED = 200, 2 / 3
#: A wrapper holds this part of the page's text; the text outside is at most this part of its own.
WRAPPER, REST = 1 / 2, 1 / 5
ARTICLE = frozenset(("article", "main"))
#: Blocks that are parts of a text, never the whole of it.
PARTS = frozenset("blockquote caption dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup legend li "
                  "ol p pre summary table tbody td tfoot th thead tr ul".split())
HEADER_WORDS = frozenset("header head".split())
CLOSES_P = BLOCK - {"body", "html"}
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class _Lines(HTMLParser):
    """Collects lines (text, characters in links, tags, element) and the elements (parent, name, marks)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        # Element 0 is the page.
        self.names, self.parents = [""], [0]
        self.hard: list[bool] = [False]
        #: The names that speak against an element; None: none does.
        self.soft: list[frozenset | None] = [None]
        self.stack: list[int] = []
        self.open, self.open_marked = Counter(), Counter()
        self.buffer: list[str] = []
        self.linked = self.tags = 0

    def flush(self):
        text = " ".join("".join(self.buffer).split())
        if text:
            self.lines.append((text, self.linked, self.tags, self.stack[-1] if self.stack else 0))
            self.tags = 0
        self.buffer, self.linked = [], 0

    def marks(self, tag: str, attrs: dict) -> tuple[bool, frozenset | None]:
        """(surely no article text, names against it) of an element."""
        if tag in EXCLUDED or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True, None
        if (attrs.get("role") or "").lower() in ROLES or HIDDEN.search(attrs.get("style") or ""):
            return True, None
        inside = any(self.open[t] for t in ARTICLE)
        if tag == "header" and not inside:
            return True, None
        if tag == "form":
            return False, frozenset(("form",))
        if tag in ("body", "html") or tag in ARTICLE and not inside:
            return False, None
        words = {w.lower() for w in NAME.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}")}
        against = words & ASIDE | (set() if inside else words & HEADER_WORDS)
        return False, frozenset(against) or None

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        if tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self._close_p()
        hard, soft = self.marks(tag, dict(attrs))
        if hard or soft:
            self.flush()
            self.open_marked[tag] += 1
        self.parents.append(self.stack[-1] if self.stack else 0)
        self.stack.append(len(self.names))
        self.open[tag] += 1
        self.names.append(tag)
        self.hard.append(hard)
        self.soft.append(soft)

    def _close_p(self):
        """A block ends an open paragraph, with all inline elements in it."""
        if not self.open["p"]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.names[self.stack[i]]
            if tag == "p":
                self._pop(i)
                return
            if tag in BLOCK:
                return

    def _pop(self, i: int):
        for e in self.stack[i:]:
            self.open[self.names[e]] -= 1
            if self.hard[e] or self.soft[e]:
                self.open_marked[self.names[e]] -= 1
        del self.stack[i:]

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK or self.open_marked[tag]:
            self.flush()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.names[self.stack[i]]
            if name == tag:
                self._pop(i)
                return
            # An inline end tag doesn't reach beyond its block.
            if tag not in BLOCK and name in BLOCK:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.names[self.stack[-1]] == tag and tag in ("svg", "iframe", "script"):
            self.handle_endtag(tag)

    def handle_data(self, data):
        self.buffer.append(data)
        if self.open["a"]:
            self.linked += len(data.strip())

    def down(self, start, step) -> list:
        """A value per element: ``step(element, value of its parent)``; parents come first."""
        out = [start]
        for e in range(1, len(self.names)):
            out.append(step(e, out[self.parents[e]]))
        return out

    def excluded(self) -> list[bool]:
        """Which elements lie in an excluded one, after weighing the names against the text."""
        hard = self.down(False, lambda e, up: up or self.hard[e])
        marked = self.down(False, lambda e, up: up or self.hard[e] or self.soft[e] is not None)
        plain, chars = [0] * len(self.names), [0] * len(self.names)
        outside = 0
        for text, linked, _, e in self.lines:
            if not hard[e]:
                plain[e] += max(0, len(text) - linked)
                chars[e] += len(text)
                outside += 0 if marked[e] else max(0, len(text) - linked)
        # An article or main without a mark of its own, below marks that are freed themselves.
        holds = [n in ARTICLE and not self.hard[e] and self.soft[e] is None for e, n in enumerate(self.names)]
        # Readers' comments in an article are no wrapper of it, whatever they hold.
        within = self.down(False, lambda e, up: up or self.names[e] in ARTICLE)
        freed = [False] * len(self.names)
        total = sum(plain)
        for e in range(len(self.names) - 1, 0, -1):
            up = self.parents[e]
            plain[up] += plain[e]
            chars[up] += chars[e]
            names = self.soft[e]
            if names is not None and not hard[e]:
                wrapper = plain[e] >= WRAPPER * total > 0 and (
                    holds[e] and not within[up] if names & READERS else holds[e] or outside <= REST * plain[e])
                freed[e] = wrapper or names <= TWO_MEANINGS and plain[e] >= max(LONG_TEXT, UNLINKED * chars[e])
            if holds[e] and (names is None and not self.hard[e] or freed[e]):
                holds[up] = True
        return self.down(False, lambda e, up: up or self.hard[e] or self.soft[e] is not None and not freed[e])


def smooth(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing with mirrored ends."""
    radius = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    padded = np.pad(ratios, radius, mode="symmetric" if len(ratios) >= radius else "edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def content_lines(page: _Lines, out: list[bool]) -> np.ndarray:
    """Which lines are content: smoothed ratio above the standard deviation.

    On pages with content inside ``article`` or ``main``, a line beside them is
    content only if its own ratio passes too: their lines don't lift it.
    """
    sizes = np.array([0 if out[e] else max(0, len(t) - linked) for t, linked, _, e in page.lines], float)
    ratios = np.array([n / max(1, tags) for n, (_, _, tags, _) in zip(sizes, page.lines)])
    smoothed = smooth(ratios)
    content = (smoothed >= smoothed.std()) & (sizes > 0)
    if not content.any():
        content = sizes > 0
    within = page.down(False, lambda e, up: up or page.names[e] in ARTICLE)
    inside = np.array([within[e] for *_, e in page.lines])
    return content & (inside | (ratios >= smoothed.std())) if (content & inside).any() else content


def region(page: _Lines, out: list[bool]) -> set[int]:
    """The elements that hold the content lines; element 0 is the whole page."""
    names, ends = page.names, [e for (*_, e), c in zip(page.lines, content_lines(page, out)) if c]
    if not ends:
        return {0}
    # The way from the page to the first content line, and how far all others share it.
    chain = [ends[0]]
    while chain[-1]:
        chain.append(page.parents[chain[-1]])
    chain.reverse()
    place = {e: i for i, e in enumerate(chain)}
    met = page.down(0, lambda e, up: place[e] if e in place else up)
    shared = chain[1:min(met[e] for e in ends) + 1]
    held = [e for e in shared if names[e] in ARTICLE]
    if held:
        articles = [e for e in held if names[e] == "article"]
        return {articles[0] if articles else held[-1]}
    outer = page.down(0, lambda e, up: up or (e if names[e] == "article" else 0))
    if all(outer[e] for e in ends):
        return {outer[e] for e in ends}
    shared = [e for e in shared if names[e] in BLOCK - PARTS]
    return {shared[-1]} if shared else {0}


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.flush()
    if not page.lines:
        return ""
    out = page.excluded()
    chosen = region(page, out)
    inside = page.down(0 in chosen, lambda e, up: up or e in chosen)
    return "\n".join(t for t, _, _, e in page.lines if not out[e] and inside[e])


def extract(html: Column | str) -> Column:
    """The main text of each whole page."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return run(F.col(html) if isinstance(html, str) else html)
