"""Main text of web pages by text-to-tag ratios of streamed parser events.

The standard library's parser streams events; every block-level tag starts a
new line. A line keeps its text, the number of tags in it and the element that
holds it; elements know their parent and the last element inside them, so deep
nesting costs no more than flat markup. Page furniture (navigation, header,
footer, sidebar, notice, advert, form, script, comments) is told by tag, role,
class and id. What a tag or role tells is final. A class or id is only a name: it
does not hide an element that holds the page's ``main``, or else all its
articles; and if the name is a mere word of a longer one (``has-sidebar``), or the
element is a form, it does not hide one that holds half of the content lines.
Text per tag of each line is smoothed by a Gaussian, and a two-means threshold
splits lines into content and the rest. On every page the content lines choose
the regions: an ``article`` (outermost) is one if a line in it is content by its
own ratio, or if it stands beside such an article and holds a smoothed content
line; a ``main`` likewise, by lines outside articles; elsewhere each run of
content lines is one, and what lies between two runs of the same element. Lines
of an article that is not chosen are left out. Regions grow over the headings
and paragraphs beside them. Every line of a region that is no furniture is kept,
in page order. Where all lines are alike all of them are content.

Defined results: null and empty pages, pages without text and pages of
furniture only give an empty text; markup cut off at the end is read as far as
it goes; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import table

SIGMA = 1.0
#: The content cluster's ratio is at least so many times the other's.
APART = 3.0
SPACE = re.compile(r"\s+")

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset(
    "script style noscript template head title nav header footer aside button select option textarea label "
    "input iframe object svg canvas audio video menu dialog".split()
)
#: Words of class and id attributes that mark furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
#: Elements whose class may name furniture without being it.
ALWAYS_OPEN = frozenset("html body main".split())
#: An open element that a new one of the given tags closes.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}}
#: Blocks over which a region grows; the others only inside an element that it has lines of.
GROWS_OVER = frozenset("h1 h2 h3 h4 h5 h6 p".split())
GROWS_INSIDE = GROWS_OVER | frozenset("blockquote pre li dt dd figcaption caption td th".split())
ROOT = -1  # stands for html and body in paths
ENDS_PARAGRAPH = BLOCKS - {"br", "option", "title", "head", "body", "html", "legend", "summary", "caption"}


#: What tells that an element is furniture: nothing, a word in a name (or a form), a whole name, tag or role.
PLAIN, WORD, NAME, SURE = range(4)


def furniture(tag: str, attributes: list[tuple[str, str | None]]) -> int:
    if tag in FURNITURE:
        return SURE
    if tag in ALWAYS_OPEN:
        return PLAIN
    told = WORD if tag == "form" else PLAIN
    for name, value in attributes:
        value = (value or "").lower()
        if name in ("class", "id"):
            for token in value.split():
                if token in MARKS:
                    told = NAME
                elif tag != "article" and not MARKS.isdisjoint(re.split(r"[^a-z]+", token)):
                    told = max(told, WORD)
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return SURE
    return told


class Lines(HTMLParser):
    """Collects lines: tags, innermost element, and pieces of text with theirs.

    Elements are numbered as they open: ``names``, ``parents`` (``ROOT`` on top),
    ``lasts`` (the last element opened inside) and ``told`` (``furniture``).
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[list[tuple[str, int]], int, int]] = []
        self.names: list[str] = []
        self.parents: list[int] = []
        self.lasts: list[int] = []
        self.told: list[int] = []
        self.open: list[int] = []
        self.opened: Counter[str] = Counter()
        self.hidden = 0
        self.parts: list[tuple[str, int]] = []
        self.tags = 0
        self.left_out = False

    def inner(self) -> int:
        return self.open[-1] if self.open else ROOT

    def end_line(self) -> None:
        seen = any(text and not text.isspace() for text, _ in self.parts)
        if seen:
            self.lines.append((self.parts, self.tags, self.inner()))
        if seen or self.left_out:
            self.tags = 0
        self.parts, self.left_out = [], False

    def pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            element = self.open.pop()
            self.lasts[element] = len(self.names) - 1
            self.opened[self.names[element]] -= 1
            self.hidden -= self.told[element] == SURE

    def close_nearest(self, tags: set[str], stop: set[str]) -> None:
        if not any(self.opened[t] for t in tags):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.names[self.open[depth]]
            if tag in tags:
                self.pop_to(depth)
                return
            if tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            if tag in ENDS_PARAGRAPH:
                self.close_nearest({"p"}, BLOCKS - {"p"})
            if tag in CLOSED_BY:
                self.close_nearest(CLOSED_BY[tag], {"ul", "ol", "dl", "select", "table", "menu"})
        self.tags += 1
        if tag not in VOID:
            self.parents.append(self.inner())
            self.open.append(len(self.names))
            self.names.append(tag)
            self.lasts.append(len(self.names) - 1)
            self.told.append(furniture(tag, attrs))
            self.opened[tag] += 1
            self.hidden += self.told[-1] == SURE

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.pop_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if self.opened[tag]:
            for depth in range(len(self.open) - 1, -1, -1):
                if self.names[self.open[depth]] == tag:
                    self.pop_to(depth)
                    break

    def handle_data(self, data: str) -> None:
        if self.hidden:
            self.left_out |= not data.isspace()
        else:
            self.parts.append((data, self.inner()))

    def unknown_decl(self, data: str) -> None:
        pass

    def finish(self) -> None:
        self.end_line()
        self.pop_to(0)


def read_lines(html: str) -> Lines:
    for source in (html, re.sub(r"<!\[[^<>]*>?", "", html)):
        parser = Lines()
        try:
            parser.feed(source)
            parser.close()
            parser.finish()
            return parser
        except AssertionError:  # the parser's answer to a malformed marked section
            continue
    return Lines()


def shown(page: Lines, hides: list[bool]) -> list[tuple[str, int, int]]:
    """(text, tags, element) of the lines outside the elements that ``hides`` marks."""
    hidden = [False] * (len(page.names) + 1)  # the last one stands for ROOT
    for element, parent in enumerate(page.parents):
        hidden[element] = hides[element] or hidden[parent]
    out = []
    for parts, tags, element in page.lines:
        text = SPACE.sub(" ", "".join(t for t, e in parts if not hidden[e])).strip()
        if text:
            out.append((text, tags, element))
    return out


def visible_lines(page: Lines, sigma: float) -> list[tuple[str, int, int]]:
    """The lines that no furniture holds, by what tags tell and what names may not hide."""
    marks = [e for e, name in enumerate(page.names) if name == "main"]
    marks = marks or [e for e, name in enumerate(page.names) if name == "article"]

    def holds_all(e: int) -> bool:
        return bool(marks) and e <= marks[0] and marks[-1] <= page.lasts[e]

    named = [told == NAME and not holds_all(e) for e, told in enumerate(page.told)]
    words = [e for e, told in enumerate(page.told) if told == WORD and not holds_all(e)]
    lines = shown(page, named)
    if not words or not lines:
        return lines
    _, strong = strong_lines(lines, sigma)
    chars = np.zeros(len(page.names) + 1, np.int64)
    for (text, _, element), good in zip(lines, strong, strict=True):
        chars[element + 1] += len(text) * int(good)  # ROOT comes first
    before = np.cumsum(chars)
    for e in words:
        named[e] = 2 * (before[page.lasts[e] + 1] - before[e]) <= before[-1]
    return shown(page, named)


def content_lines(ratios: np.ndarray, sigma: float = SIGMA) -> tuple[np.ndarray, float]:
    """Which lines have a high text-to-tag ratio after smoothing (two means), and from which ratio on."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    smooth = np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight
    low, high = smooth.min(), smooth.max()
    for _ in range(20):
        upper = smooth >= (low + high) / 2
        if upper.all() or not upper.any():
            break
        low, high = smooth[~upper].mean(), smooth[upper].mean()
    # Alike lines are not two clusters.
    if high < APART * low:
        return np.ones(len(smooth), bool), 0.0
    return smooth >= (low + high) / 2, (low + high) / 2


def runs(mask: np.ndarray) -> list[range]:
    """Ranges of adjoining true positions."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [range(i, j) for i, j in zip(edges[::2], edges[1::2], strict=True)]


def strong_lines(lines: list[tuple[str, int, int]], sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """Content lines after smoothing, and those that are so by their own ratio too."""
    ratios = np.array([len(text) / max(1, tags) for text, tags, _ in lines])
    content, least = content_lines(ratios, sigma)
    strong = content & (ratios >= least)
    return content, strong if strong.any() else content


class Tree:
    """Blocks, articles and mains around each element, from its parent's."""

    def __init__(self, page: Lines) -> None:
        names = page.names
        self.lasts = page.lasts
        n = len(names)
        self.block, self.above = [ROOT] * n, [ROOT] * n  # nearest block, the block around that
        self.depth, self.article, self.main = [0] * n, [None] * n, [None] * n
        for e, up in enumerate(page.parents):
            inside = up != ROOT
            own = names[e] in BLOCKS and names[e] not in ("html", "body")
            around = self.block[up] if inside else ROOT
            self.block[e] = e if own else around
            self.above[e] = around if own else (self.above[around] if around != ROOT else ROOT)
            self.depth[e] = (self.depth[up] if inside else 0) + own
            self.article[e] = (self.article[up] if inside else None)
            self.main[e] = (self.main[up] if inside else None)
            if names[e] == "article" and self.article[e] is None:
                self.article[e] = e
            if names[e] == "main" and self.main[e] is None:
                self.main[e] = e

    def holds(self, a: int, e: int) -> bool:
        return a == ROOT or e != ROOT and a <= e <= self.lasts[a]


def in_regions(page: Lines, elements: list[int], content: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """Which lines belong to the regions that the content lines choose."""
    n, tree = len(elements), Tree(page)

    def of(values: list, e: int, top):
        return top if e == ROOT else values[e]

    articles = [of(tree.article, e, None) for e in elements]
    mains = [of(tree.main, e, None) for e in elements]
    own_block = [of(tree.block, e, ROOT) for e in elements]
    blocks = [page.names[b] if b != ROOT else "" for b in own_block]
    within = [of(tree.above, e, ROOT) for e in elements]
    parent = {a: tree.above[a] for a in articles if a is not None}  # the block around each article
    chosen = {articles[i] for i in np.flatnonzero(strong)} - {None}
    beside = {parent[e] for e in chosen}
    chosen |= {e for i in np.flatnonzero(content) if (e := articles[i]) is not None and parent[e] in beside}
    chosen_mains = {mains[i] for i in np.flatnonzero(strong) if articles[i] is None} - {None}
    open_ = np.array([e is None or e in chosen for e in articles])
    keep = np.array([articles[i] in chosen or open_[i] and mains[i] in chosen_mains for i in range(n)], bool)
    free = np.array([articles[i] is None and mains[i] not in chosen_mains for i in range(n)])
    ends: dict[int, list[int]] = {}
    for run in runs(content & free):
        if strong[run.start : run.stop].any():
            keep[run.start : run.stop] = True
            for i in run:
                ends.setdefault(within[i], []).append(i)
    filled = np.zeros(n + 1, np.int64)
    for own in ends.values():
        filled[min(own)] += 1
        filled[max(own) + 1] -= 1
    keep |= open_ & (np.cumsum(filled[:-1]) > 0)

    def joins(i: int, near: int) -> bool:
        """Whether line ``i`` goes with the kept line ``near`` beside it."""
        around = within[near] if articles[near] is None else parent[articles[near]]
        if not open_[i]:
            return False
        if tree.holds(within[i], around):
            return blocks[i] in GROWS_OVER
        if around != ROOT and tree.holds(around, within[i]):
            return blocks[i] in GROWS_INSIDE
        # A section beside the section of the kept line.
        section = tree.above[within[i]]
        return tree.depth[within[i]] > 1 and tree.holds(section, around) and blocks[i] in GROWS_OVER

    for order in (range(1, n), range(n - 2, -1, -1)):
        for i in order:
            near = i - order.step
            keep[i] |= bool(keep[near]) and not keep[i] and joins(i, near)
    return keep


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The page's main text, its blocks joined by one space."""
    if not html:
        return ""
    page = read_lines(html)
    lines = visible_lines(page, sigma)
    if not lines:
        return ""
    content, strong = strong_lines(lines, sigma)
    keep = in_regions(page, [element for _, _, element in lines], content, strong)
    return " ".join(line[0] for line, kept in zip(lines, keep, strict=True) if kept)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    return pages.withColumn(text, texts(F.col(html)))


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
