"""Operator 9: the main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags.  Every word and tag has a score: words start
positive and tags negative, and each name of the containers around them (the tag, and the words
of its class, id and role, whole names apart from parts of names) adds its weight once.  One linear
scan finds the contiguous region with the largest sum; blocks that it touches belong to
the text, except for words whose own score isn't positive and for what lies in elements
that never hold main text (menus, footers, forms...).  So no name drops anything by
itself: its weight stands against the weights of the names around it, and within marked
text only a name that is strongly known for adverts or comments outweighs the mark.  On
pages that mark their text, words outside of it score negative.

The weights are learnt from labelled pages: those that mark their text themselves with
``article`` or ``main``.  Over all pages, a name's words inside and outside that text are counted; its
weight is the log odds, next to pseudo-counts for usual names.  Names are hashed to a
fixed number of cells, so the table of weights is bounded.

Containers that wrap the page's text (``wrappers``) don't weigh by names that speak against it, and
a mark within other such containers (a card in a list of related pages) is none.
Each event costs the same however deep it lies: a container carries the weight of all around it.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import reach_workers, tidied

CELLS = 1 << 16
WORD, TAG = 0.3, -0.8
#: Upper and lower bound of a name's weight.
CLIP, FLOOR = 3.0, -8.0
#: Weight of a container that holds text.
WITHIN = 1.0
#: Words that usual names count for: those of texts and of places outside of them, those known for adverts and
#: comments as whole names and as parts of names, and words that may as well be a subject of the text.
USUAL_WORDS, STRONG_WORDS, PART_WORDS, WEAK_WORDS = 30, 1_000, 100, 10

# Elements and names of HTML.
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "svg", "title", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "button", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr"}
CONTAINERS = {"html", "head", "body", "article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol",
              "dl", "table", "figure", "details", "dialog", "fieldset", "menu", "blockquote", "center"}
#: Containers of any purpose: only their names weigh.
PLAIN = {"html", "body", "section", "div", "ul", "ol", "dl", "table", "figure", "details", "fieldset", "blockquote", "center"}
TEXT_MARKS = ("article", "main")
DROPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "object", "audio", "video", "canvas"}
STRONG_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "breadcrumb", "breadcrumbs", "comment", "comments", "contentinfo",
                "cookie", "cookies", "disqus", "navbar", "navigation", "newsletter", "respond", "sidebar", "sponsor", "sponsored"}
WEAK_NAMES = {"banner", "complementary", "footer", "menu", "nav", "notice", "popup", "promo", "related", "search", "share", "sharing",
              "social", "subscribe", "toolbar", "widget"}
USUAL_OUTSIDE = {"copyright", "header", "legal", "masthead", "topbar"}
USUAL_TEXT = {"article", "articlebody", "content", "entry", "main", "post", "story"}

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def cell(name: str) -> int:
    return zlib.crc32(name.encode()) % CELLS


@functools.lru_cache(maxsize=1 << 14)
def names_of(tag: str, attributes: str) -> tuple[str, ...]:
    """A container's features: its tag, unless plain, and the words of its class, id and role, ``.word`` for a
    whole name and ``-word`` for a part of one.  Names such as ``with-sidebar`` or ``has-menu`` speak of other
    elements and don't count."""
    own = () if tag in PLAIN else (tag,)
    if not attributes:
        return own
    found = []
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = [p for p in _PARTS.split(name) if p]
            if not {"has", "with", "no"} & set(parts):
                found += [f".{p}" for p in parts] if len(parts) == 1 else [f"-{p}" for p in parts]
    return (*own, *dict.fromkeys(found))


def _against(name: str) -> bool:
    """Whether a name's word speaks against main text."""
    return name[0] in ".-" and (name[1:] in STRONG_NAMES or name[1:] in WEAK_NAMES or name[1:].startswith("comment"))


class Open:
    """An open container: its tag and names; whether it or one around it is dropped by its tag, has a name
    against the text, marks the text, or weighs so much that it holds text; its number in the page; the
    summed weight of all names around its content."""

    __slots__ = ("tag", "names", "dropped", "against", "marked", "within", "number", "weight")

    def __init__(self, tag: str, names: tuple[str, ...], above: "Open | None", number: int, marks: bool) -> None:
        self.tag, self.number, self.weight, self.within = tag, number, 0.0, False
        self.dropped = (above is not None and above.dropped) or tag in DROPPED or (tag == "header" and not (above and above.marked))
        self.against = (above is not None and above.against) or any(map(_against, names))
        self.marked = (above is not None and above.marked) or (marks and tag in TEXT_MARKS and not self.against)
        self.names = names if self.marked or tag not in TEXT_MARKS else tuple(n for n in names if n != tag)


class Page:
    """Calls ``text(raw, container)``, ``tag(name, container, ends a block)``, ``opened(container)`` and
    ``closed(container)`` in page order; ``container`` is the innermost open one or None.  Names that speak
    against the text don't count for containers numbered in ``spared``; ``marks`` says whether the page's own
    marks are trusted."""

    def __init__(self, weight: np.ndarray | None = None, spared: frozenset[int] = frozenset(), marks: bool = True) -> None:
        self.weight, self.spared, self.marks = weight, spared, marks

    def text(self, raw: str, container: Open | None) -> None: ...

    def tag(self, name: str, container: Open | None, ends: bool) -> None: ...

    def opened(self, container: Open) -> None: ...

    def closed(self, container: Open) -> None: ...

    def walk(self, page: str) -> None:
        stack: list[Open] = []
        places: dict[str, list[int]] = {}                   # tag -> where it stands in the stack
        known: dict[str, int] = {}                          # name -> open containers with it
        at, size, number = 0, len(page), 0

        def close(to: int) -> None:
            while len(stack) > to:
                last = stack.pop()
                places[last.tag].pop()
                for n in last.names:
                    known[n] -= 1
                self.closed(last)

        while at < size:
            m = _TAG.search(page, at)
            if not m:
                self.text(page[at:], stack[-1] if stack else None)
                break
            if m.start() > at:
                self.text(page[at:m.start()], stack[-1] if stack else None)
            at, name = m.end(), (m[2] or "").lower()
            if not name:
                continue
            if m[1]:
                if places.get(name):
                    close(places[name][-1])
            elif name in RAW:
                if not m[3].endswith("/") or name != "svg":
                    end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else size
            elif name in CONTAINERS or name in DROPPED:
                names, number = names_of(name, m[3]), number + 1
                if number in self.spared:
                    names = tuple(n for n in names if not _against(n))
                above = stack[-1] if stack else None
                here = Open(name, names, above, number, self.marks)
                if self.weight is not None:
                    new = sum(float(self.weight[cell(n)]) for n in here.names if not known.get(n))
                    here.weight = min((above.weight if above else 0.0) + new, CLIP)
                    here.within = (above is not None and above.within) or here.weight >= WITHIN
                for n in here.names:
                    known[n] = known.get(n, 0) + 1
                places.setdefault(name, []).append(len(stack))
                stack.append(here)
                self.opened(here)
            self.tag(name, stack[-1] if stack else None, name not in INLINE)
        close(0)


class _Wrapping(Page):
    """Which containers with a name against the text hold how many words, and which marks lie in them."""

    def __init__(self) -> None:
        super().__init__()
        self.words = 0
        self.inner = [0]                                    # open containers with such names, the innermost last
        self.held: dict[int, int] = {}                      # number -> words before, and then within it
        self.partly: set[int] = set()
        self.around: dict[int, int] = {0: 0}                # number -> the next such container around it
        self.marks: list[tuple[str, int, int]] = []         # mark, words, innermost such container

    def text(self, raw: str, container: Open | None) -> None:
        if not (container and container.dropped):
            self.words += len(raw.split())

    def opened(self, c: Open) -> None:
        if c.tag in TEXT_MARKS or any(map(_against, c.names)):
            self.held[c.number] = self.words
        if not c.dropped and c.tag not in (*TEXT_MARKS, "body", "html") and any(map(_against, c.names)):
            self.around[c.number] = self.inner[-1]
            self.inner.append(c.number)
            if not any(_against(n) and n[0] == "." for n in c.names):
                self.partly.add(c.number)

    def closed(self, c: Open) -> None:
        if c.number in self.held:
            self.held[c.number] = self.words - self.held[c.number]
        if c.number == self.inner[-1]:
            self.inner.pop()
        if c.tag in TEXT_MARKS and not c.dropped:
            self.marks.append((c.tag, self.held[c.number], self.inner[-1]))


def wrappers(page: str) -> tuple[frozenset[int], bool]:
    """Numbers of the containers whose names don't speak against their content, as they wrap the page's
    text: those around the longest ``main`` or, if all of them lie in such containers, ``article``; in a page
    without either, those with such words as parts of names that hold more than half of its words.  And
    whether a mark with words is left outside of all other such containers."""
    seen = _Wrapping()
    seen.walk(page)
    marks = [m for m in seen.marks if m[1]]
    if not marks:
        return frozenset(k for k in seen.partly if 2 * seen.held[k] > seen.words), False
    inside = [m for m in marks if m[2] and m[0] == "main"]
    if not inside and all(m[2] for m in marks):
        inside = marks
    out, k = set(), max(inside, key=lambda m: m[1])[2] if inside else 0
    while k:
        out.add(k)
        k = seen.around[k]
    return frozenset(out), True


class _Counting(Page):
    """Words under each name, outside and inside the marked text."""

    def __init__(self, spared: frozenset[int], marks: bool) -> None:
        super().__init__(None, spared, marks)
        self.words = [0, 0]
        self.since: dict[str, tuple[int, int, int]] = {}    # name -> open containers with it, words before the first
        self.seen: Counter = Counter()

    def text(self, raw: str, c: Open | None) -> None:
        # the mark says nothing of what its page names an advert or a comment, say
        if c and not (c.marked and c.against):
            self.words[c.marked and not c.dropped] += len(raw.split())

    def opened(self, c: Open) -> None:
        for n in c.names:
            depth, out, in_ = self.since.get(n, (0, *self.words))
            self.since[n] = depth + 1, out, in_

    def closed(self, c: Open) -> None:
        for n in c.names:
            depth, out, in_ = self.since.pop(n)
            if depth > 1:
                self.since[n] = depth - 1, out, in_
            else:
                self.seen[n, 0] += self.words[0] - out
                self.seen[n, 1] += self.words[1] - in_


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell: words outside and inside the marked text of labelled pages."""
    for batch in batches:
        table = np.zeros((CELLS, 2), np.int64)
        for page in batch.column(0).to_pylist():
            own = _Counting(*wrappers(page or ""))
            own.walk(page or "")
            if own.words[1]:
                for (name, inside), n in own.seen.items():
                    table[cell(name), inside] += n
        used = np.flatnonzero(table.any(axis=1))
        yield pa.record_batch({"cell": pa.array(used, pa.int32()), "outside": pa.array(table[used, 0]), "inside": pa.array(table[used, 1])})


def learn_weights(pages: DataFrame, column: str = "html") -> np.ndarray:
    """The weight of each cell, from all pages that mark their text (at most CELLS rows reach
    the driver).  Without such pages, usual names alone weigh."""
    reach_workers(pages.sparkSession)
    rows = (pages.select(F.col(column).alias("html")).mapInArrow(tidied(_counts), "cell int, outside long, inside long")
            .groupBy("cell").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside")).collect())
    return weights({r["cell"]: (r["outside"], r["inside"]) for r in rows})


def weights(counts: dict[int, tuple[int, int]]) -> np.ndarray:
    """The log odds of each cell from words outside and inside, next to those of usual names."""
    table = np.ones((CELLS, 2))
    for c, n in counts.items():
        table[c] += n
    for names, side, words in (
            (DROPPED, 0, USUAL_WORDS), ({f".{n}" for n in USUAL_OUTSIDE}, 0, USUAL_WORDS),
            (USUAL_TEXT | {f".{n}" for n in USUAL_TEXT}, 1, USUAL_WORDS), ({f"-{n}" for n in USUAL_TEXT}, 1, WEAK_WORDS),
            ({f".{n}" for n in STRONG_NAMES}, 0, STRONG_WORDS), ({f"-{n}" for n in STRONG_NAMES}, 0, PART_WORDS),
            ({f"{k}{n}" for n in WEAK_NAMES for k in ".-"}, 0, WEAK_WORDS)):
        for n in names:
            table[cell(n), side] += words
    # cells that hardly any page uses say little
    return np.clip(np.log(table[:, 1] / table[:, 0]) * np.minimum(1, (table.sum(axis=1) - 2) / WEAK_WORDS), FLOOR, CLIP)


class _Scan(Page):
    """The scores of a page's words and tags in order, and its blocks of kept words."""

    def __init__(self, weight: np.ndarray, spared: frozenset[int], marks: bool) -> None:
        super().__init__(weight, spared, marks)
        self.blocks: list[list[str]] = [[]]
        self.scores: list[float] = []
        self.places: list[int] = []

    def around(self, c: Open | None) -> float:
        """What surrounds a word or tag: on a page with marks, nothing speaks for what is outside of them."""
        weight = c.weight if c else 0.0
        return min(weight, 0.0) - 2 * WORD if self.marks and not (c and c.marked) else weight

    def text(self, raw: str, c: Open | None) -> None:
        words, weight = html.unescape(raw), WORD + self.around(c)
        kept = weight > 0 and not (c and c.dropped)
        if n := len(words.split()):
            # what is left out within a text doesn't part it
            self.scores.append(0.0 if c and c.within and not kept else n * weight)
            self.places.append(len(self.blocks) - 1 if kept else -1)
        if kept:
            self.blocks[-1].append(words)

    def tag(self, name: str, c: Open | None, ends: bool) -> None:
        weight = self.around(c)
        self.scores.append(0.0 if c and c.within and (WORD + weight <= 0 or c.dropped) else weight + TAG)
        self.places.append(-1)
        if ends:
            self.blocks.append([])
        elif name == "br":
            self.blocks[-1].append(" ")


def best_region(scores: list[float]) -> tuple[int, int] | None:
    """First and last place of the contiguous region with the largest positive sum."""
    best, total, lo, region = 0.0, 0.0, 0, None
    for i, s in enumerate(scores):
        if total <= 0:
            total, lo = 0.0, i
        total += s
        if total > best:
            best, region = total, (lo, i)
    return region


def extract(page: str, weight: np.ndarray) -> str:
    """The main text of one page: its blocks joined by an empty line."""
    scan = _Scan(weight, *wrappers(page))
    scan.walk(page)
    region = best_region(scan.scores)
    touched = [p for p in scan.places[region[0]:region[1] + 1] if p >= 0] if region else []
    if not touched:
        return ""
    out = (" ".join("".join(b).split()) for b in scan.blocks[touched[0]:touched[-1] + 1])
    return "\n\n".join(b for b in out if b)


def main_text(pages: DataFrame, weight: np.ndarray | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages(page_id, url, html)``.

    Null, blank and text-free pages give an empty text; null keys and repeated rows are kept.
    """
    spark = pages.sparkSession
    reach_workers(spark)
    shared = spark.sparkContext.broadcast(learn_weights(pages) if weight is None else weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x or "", shared.value) for x in batch.column(2).to_pylist()]
            yield pa.record_batch({"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        tidied(run), "page_id long, url string, text string, n_chars long")
