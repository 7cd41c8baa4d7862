"""Main text of HTML pages by tag-path ratios.

Every text node belongs to the path of elements from the root down to it. Per path, the
mean text length and the mean number of punctuation marks of its nodes are taken, each
relative to the page's largest; both are smoothed over neighbouring nodes, fused into
their mean, and compared with a threshold. The element that encloses nearly all of the
text so selected is the article. How large a share of the best path's score a node needs
there follows from what marks it and the elements around it (REQUIRED): none where nothing
does, as an article keeps its short lines and headings; the threshold for words that a part
of an article may go by as well (WEAK: discussion, notice and so on); and more than any
path has for menus, adverts, comments and so on. Outside the article only selected nodes
count, and none at all where the page itself names its article or main part.

A mark is a class, id or role, or the kind of element. Of a compound name the first or last
part marks it (comments-section, user-comments), unless a part denies it (no-comments,
has-sidebar); a weak one as strongly as others if all else in the name is a general word
(related-posts, notice-box, but not related-work). A mark leaves an element out unless that
holds the main part or only article that the page itself names. On a page that names none,
or only a hidden or empty one, neither a mark nor hiding counts on an element with most of
the text that the ratios select. Headings are never marked by name.

Pages are independent: nothing is shuffled and a task holds one batch of pages. Time and
memory grow in proportion to a page's length, however broken its markup.

Defined results: NULL or empty html and pages without text give an empty text. Comments
and elements that are never closed end with the page; end tags without a start tag are
passed over. A page of only short texts yields the best of its paths. Bytes that are not
UTF-8 read as U+FFFD. Repeated rows get equal results. Columns of the input that are not
needed are left alone.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A path is content if its fused ratio reaches this share of the page's largest.
THRESHOLD = 0.25
# Weights of the neighbouring nodes in smoothing.
KERNEL = np.array([0.1, 0.2, 0.4, 0.2, 0.1])
# The article is the smallest element that holds this share of the selected text.
ARTICLE_SHARE = 0.8
# A mark does not count on an element that holds more than this share of it.
MOST = 0.5

# Quotes hold a value together where they follow "=", and are letters elsewhere.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>|<[!?/][^>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NOT_SHOWN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟،]")
NAME_PARTS = re.compile(r"[a-z]+")

# Names of HTML elements, and words in class, id and role that mark an
# element as something other than the article.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript template textarea iframe title svg math object".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark "
    "q s samp small span strike strong sub sup time tt u var wbr br".split()
)
OTHER = set("nav header footer aside form button select dialog menu script style".split())
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "menu menus nav navbar navigation breadcrumb breadcrumbs sidebar side aside complementary "
    "header masthead topbar footer contentinfo comment comments commentlist reply replies respond "
    "discussion disqus share sharing social related recommended recommendations newsletter "
    "subscribe signup login search pagination pager widget widgets toolbar toc skip dialog "
    "copyright disclaimer".split()
)
# Marks that a part of the article itself may carry.
WEAK = set(
    "notice notices alert side related header respond reply replies discussion social sponsor "
    "sponsors recommended recommendations search copyright disclaimer toc banner masthead".split()
)
# Parts of a name that deny what another part says, that add nothing to it, and that make
# a header one of the article.
DENIALS = set("no not non without has have with hide".split())
GENERAL = set(
    "section sections area areas list lists box boxes bar bars block blocks slot slots unit units "
    "container wrapper wrap panel pane column col row item items group inner outer content form "
    "field button buttons icon icons link links image media module section left right top bottom "
    "main primary secondary site page global user users reader readers visitor post posts article "
    "articles entry story stories news blog more sticky floating inline mobile desktop".split()
)
OWN_HEADERS = set("article post entry story section content chapter title".split())
# Elements that no name marks.
UNMARKED = set("html body main article h1 h2 h3 h4 h5 h6".split())
# What an element is left out for, and the share of the best path's score that a node below
# it needs all the same.
SHOWN, WEAKLY, MARKED, UNSEEN = range(4)
REQUIRED = np.array([0.0, THRESHOLD, np.inf, np.inf])
# Start tags that end an open element of these kinds, up to the nearest container.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
CONTAINERS = set("ul ol dl table body article section div main html td th".split())


class Page:
    """The text nodes of a page: block, path and article candidates of each."""

    def __init__(self, html: str):
        self.paths: dict[tuple[int, str], int] = {}
        self.texts: list[str] = []
        self.path_of: list[int] = []
        self.block_of: list[int] = []
        self.element_of: list[int] = []
        self.parents = [-1]
        self.tags = [""]
        self.marks = [SHOWN]
        # Open elements: tag, path, number of the element. Places in that list by tag, of
        # containers, and of all that are not inline, so that none has to be looked for.
        self.open: list[tuple[str, int, int]] = [("", 0, 0)]
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.containers = [0]
        self.blocks = [0]
        self.block = 0
        self.parse(html)

    def parse(self, html: str) -> None:
        # Behind the last ">" no tag ends.
        at, end_of_tags = 0, html.rfind(">") + 1
        while match := TOKEN.search(html, at, end_of_tags):
            self.text(html[at : match.start()])
            at = match.end()
            if match[0].startswith("<!--") and not match[0].endswith("-->"):
                return
            closing, tag, attributes = match.groups()
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self.close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                if not end:
                    return
                at = end.end()
            else:
                self.start(tag, attributes)
        rest = html[at:]
        # What follows a tag that is never finished is not text.
        cut = re.search(r"<[a-zA-Z/!?]", rest)
        self.text(rest[: cut.start()] if cut else rest)

    def text(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.texts.append(text)
            self.path_of.append(self.open[-1][1])
            self.block_of.append(self.block)
            self.element_of.append(self.open[-1][2])

    def start(self, tag: str, attributes: str) -> None:
        inline = tag in INLINE
        if not inline:
            self.block += 1
            self.end_implied({"p"} if tag not in ENDS else ENDS[tag] | {"p"})
        if tag in VOID:
            if tag == "br":
                self.text(" ")
            return
        names: dict[str, str] = {}
        for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
            names.setdefault(name.lower(), value.strip("\"'").lower())
        mark = SHOWN
        if (
            "hidden" in names
            or names.get("aria-hidden") == "true"
            or NOT_SHOWN.search(names.get("style", ""))
        ):
            mark = UNSEEN
        elif tag in OTHER:
            mark = MARKED
        elif tag not in UNMARKED:
            mark = self.marked(names)
        label = f"{tag}.{names.get('class') or names.get('id', '')}"
        path = self.paths.setdefault((self.open[-1][1], label), len(self.paths) + 1)
        self.parents.append(self.open[-1][2])
        self.tags.append(tag)
        self.marks.append(mark)
        if attributes.endswith("/") and tag not in CONTAINERS and not inline:
            return
        depth = len(self.open)
        self.open.append((tag, path, len(self.parents) - 1))
        self.places[tag].append(depth)
        if tag in CONTAINERS:
            self.containers.append(depth)
        if not inline:
            self.blocks.append(depth)

    @staticmethod
    def marked(names: dict[str, str]) -> int:
        return max(
            name_mark(token)
            for name in ("class", "id", "role")
            for token in names.get(name, "").split() or [""]
        )

    def end(self, depth: int) -> None:
        """End the open element at this depth, and all inside it."""
        while len(self.open) > depth:
            tag = self.open.pop()[0]
            self.places[tag].pop()
            for places in (self.containers, self.blocks):
                if places[-1] == len(self.open):
                    places.pop()

    def end_implied(self, tags: set[str]) -> None:
        """End open elements of these tags, up to the nearest container."""
        while True:
            depth = max((self.places[tag][-1] for tag in tags if self.places[tag]), default=0)
            if not depth or depth < self.containers[-1]:
                return
            self.end(depth)

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.block += 1
        places = self.places[tag]
        # An inline end tag does not reach beyond the block it stands in.
        if places and (tag not in INLINE or places[-1] > self.blocks[-1]):
            self.end(places[-1])


def name_mark(token: str) -> int:
    """What a class, id or role says about an element."""
    parts = NAME_PARTS.findall(token)
    marks = MARKS.intersection(parts[:1] + parts[-1:])
    if not marks or DENIALS.intersection(parts):
        return SHOWN
    rest = set(parts) - MARKS
    if marks == {"header"} and rest & OWN_HEADERS:
        return SHOWN
    weak = marks <= WEAK and not (rest and rest <= GENERAL)
    return WEAKLY if weak else MARKED


def smooth(values: np.ndarray) -> np.ndarray:
    return np.convolve(np.pad(values, len(KERNEL) // 2, mode="edge"), KERNEL, "valid")


def node_scores(page: Page, left_out: list[bool]) -> np.ndarray:
    """The score of each text node's path as a share of the best; 0 for nodes without text
    and for those left out, which have no part in it."""
    share = np.zeros(len(page.texts))
    lengths = np.array([len(t.strip()) for t in page.texts], dtype=np.int64)
    out = np.array(left_out)[np.array(page.element_of, dtype=np.int64)]
    shown = np.flatnonzero((lengths > 0) & ~out)
    if not len(shown):
        return share
    paths = np.array(page.path_of)[shown]
    marks = np.array([len(PUNCTUATION.findall(page.texts[i])) for i in shown])
    _, path, nodes = np.unique(paths, return_inverse=True, return_counts=True)
    fused = np.zeros(len(shown))
    for values in (lengths[shown], marks):
        ratio = (np.bincount(path, weights=values) / nodes)[path]
        fused += smooth(ratio / max(ratio.max(), 1)) / 2
    score = np.bincount(path, weights=fused) / nodes
    share[shown] = (score / score.max() if score.max() > 0 else np.ones(len(score)))[path]
    return share


def inherited(page: Page, own: list[bool]) -> list[bool]:
    """Whether ``own`` holds for each element or one above it."""
    found = list(own)
    for element in range(1, len(found)):
        found[element] = found[element] or found[page.parents[element]]
    return found


def counted_marks(page: Page, selected: np.ndarray) -> list[int]:
    """The marks of the elements, without those of elements that hold the article."""
    only = page.tags.count("article") == 1
    named = [tag == "main" or (only and tag == "article") for tag in page.tags]
    holds = list(named)
    length = [0] * len(page.parents)
    for i in selected:
        length[page.element_of[i]] += len(page.texts[i])
    for element in range(len(page.parents) - 1, 0, -1):
        length[page.parents[element]] += length[element]
        holds[page.parents[element]] |= holds[element]
    marks = [
        SHOWN if own and mark != UNSEEN else mark
        for own, mark in zip(holds, page.marks, strict=True)
    ]
    out = inherited(page, [mark != SHOWN for mark in marks])
    inside = inherited(page, named)
    if any(inside[e] and not out[e] and t.strip() for e, t in zip(page.element_of, page.texts)):
        return marks
    most = MOST * length[0]
    return [SHOWN if size > most else mark for size, mark in zip(length, marks, strict=True)]


def article(page: Page, selected: np.ndarray) -> tuple[int, bool]:
    """The element that holds nearly all of the selected text: the nearest one that the
    page itself calls an article or its main part (True), else the smallest container."""
    below: Counter[int] = Counter()
    for i in selected:
        below[page.element_of[i]] += len(page.texts[i])
    total = sum(below.values())
    for element in range(len(page.parents) - 1, 0, -1):
        if below[element] >= ARTICLE_SHARE * total and total:
            break
        below[page.parents[element]] += below[element]
    else:
        return 0, False
    above = [element]
    while page.parents[above[-1]] > 0:
        above.append(page.parents[above[-1]])
    for wanted in ({"article"}, {"main"}, CONTAINERS):
        if found := [e for e in above if page.tags[e] in wanted]:
            return found[0], wanted is not CONTAINERS
    return above[-1], False


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Page(html)
    if not page.texts:
        return ""
    of_all = node_scores(page, [False] * len(page.parents))
    marks = counted_marks(page, np.flatnonzero(of_all >= THRESHOLD))
    for element in range(1, len(marks)):
        marks[element] = max(marks[element], marks[page.parents[element]])
    shown = node_scores(page, [mark != SHOWN for mark in marks])
    selected = np.flatnonzero(shown >= THRESHOLD)
    if not len(selected):
        return ""
    element, named = article(page, selected)
    own = [False] * len(page.parents)
    own[element] = True
    element_of = np.array(page.element_of)
    inside = np.array(inherited(page, own))[element_of]
    kept = inside & (of_all >= REQUIRED[np.array(marks)[element_of]])
    if not named:
        kept |= shown >= THRESHOLD
    blocks: defaultdict[int, list[str]] = defaultdict(list)
    for i in np.flatnonzero(kept):
        blocks[page.block_of[i]].append(page.texts[i])
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(text for text in joined if text)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch["html"].cast(pa.binary()).to_pylist()
            texts = [main_text((raw or b"").decode("utf-8", "replace")) for raw in raws]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
