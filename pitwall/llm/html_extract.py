"""Main text of HTML pages as the maximum-scoring contiguous region.

A page is read once as a sequence of words and tags. Words score positive, tags negative; how much
a tag costs is learned from pages that mark their article themselves: a kind of tag (name and
class) that stands outside articles costs most. A linear scan keeps the best contiguous region.
Every article the region touches is kept whole. Elements that are never part of an article (menus,
forms, scripts, reader comments and so on, by name or by a class that says nothing else) score no
words and are left out wherever they stand, unless a class marks an element around most of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import per_text

# Element names with a role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math title".split())
LEFT_OUT = frozenset(
    "head nav header footer aside form button select option dialog menu object video audio canvas "
    "fieldset script style noscript template textarea iframe svg math title".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol "
    "option p pre section summary table tbody tfoot thead tr ul".split()
)
CONTAINERS = frozenset(("article", "main"))
# Words in a class, id or role that mark what is no article text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar rail "
    "header masthead footer cookie cookies consent gdpr notice notification alert popup modal "
    "newsletter subscribe subscription signup login related "
    "recommended recommendations share sharing social toolbar widget search form skip "
    "complementary contentinfo hidden".split()
)
READER_HINTS = frozenset("comment comments commentlist disqus replies respond".split())
# Words that say nothing of their own beside one of those.
PLAIN = frozenset(
    "area bar block bottom box button buttons center col column container global group inner "
    "item items left link links list main mobile outer page panel primary right row secondary "
    "section site slot top unit user wrap wrapper".split()
)
READER_PLAIN = PLAIN | frozenset("article blog form post reader readers thread".split())
#: Level of elements with text of readers; an article inside them is one of theirs.
READERS = 2
SPACING = frozenset("br td th".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_TAG_STEP = re.compile(r">|=\s*([\"'])")
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    """A stretch of text between block tags: pieces of (mark, words, text)."""

    pieces: list[tuple[int, int, str]] = field(default_factory=list)
    words: int = 0
    cost: float = 0.0
    container: int = 0


def tag_kind(name: str, rest: str) -> str:
    """Name of a tag with its class words, the unit that has a weight."""
    if not rest:
        return name
    marks = sorted({part for match in _MARKS.finditer(rest) for part in _words(match)})
    return ".".join([name, *marks])


def _words(match: re.Match) -> list[str]:
    value = match[1] or match[2] or match[3] or ""
    return [part.lower() for part in _PARTS.findall(value)]


def out_level(name: str, rest: str) -> int:
    """0 for article text, 1 for elements marked by class, id or role, 2 for those of readers.

    One class name counts only if all its words speak of such an element: ``cookie-notice`` and
    ``site-header`` do, ``content-with-sidebar`` and ``article-header`` do not.
    """
    level = 0
    if not rest or name in ("html", "body"):
        return level
    for match in _MARKS.finditer(rest):
        for single in (match[1] or match[2] or match[3] or "").split():
            parts = {part.lower() for part in _PARTS.findall(single)}
            if parts & READER_HINTS and parts <= READER_HINTS | READER_PLAIN:
                return READERS
            if name not in CONTAINERS and parts & HINTS and parts <= HINTS | PLAIN:
                level = 1
    return level


class TagEnds:
    """Where tags of a page end, in time linear in the page however broken it is.

    Quotes count behind an equals sign only. Quotes found to lead to no end are remembered, so
    that no stretch is searched again from each of them.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.lost: set[int] = set()
        self.from_, self.step = 0, _TAG_STEP.search(page)

    def _next(self, at: int) -> re.Match | None:
        if not (self.from_ <= at and (self.step is None or at <= self.step.start())):
            self.from_, self.step = at, _TAG_STEP.search(self.page, at)
        return self.step

    def end(self, at: int) -> int:
        """Place of the sign that ends the tag whose name ends at ``at``, -1 if there is none.

        Where a quote is never closed, the next such sign ends the tag.
        """
        opened, place = [], at
        while step := self._next(place):
            if step[1] is None:
                return step.start()
            quote = step.end() - 1
            if quote in self.lost:
                break
            opened.append(quote)
            place = self.page.find(step[1], quote + 1) + 1
            if not place:
                break
        self.lost.update(opened)
        return self.page.find(">", at)


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, text or attributes) with kinds ``text``, ``open``, ``close``.

    The content of scripts, styles and the like is skipped; comments and declarations too.
    """
    start = at = 0  # of the text not yet given, of the search
    size, ends, lowered = len(page), TagEnds(page), None
    while (sign := page.find("<", at)) >= 0:
        close = page.startswith("/", sign + 1)
        name = _NAME.match(page, sign + 1 + close)
        comment = page.startswith("!--", sign + 1)
        if comment:
            end = page.find("-->", sign + 2)
            end = size if end < 0 else end + 2
        elif name:
            end = ends.end(name.end())
        elif page.startswith(("!", "?", "/"), sign + 1):
            end = page.find(">", sign)
        else:
            at = sign + 1
            continue
        if end < 0:
            break  # no tag ends behind this place: the rest is text
        if start < sign:
            yield "text", "", page[start:sign]
        start = at = end + 1
        if comment or not name:
            continue
        found = name[0].lower()
        if close:
            yield "close", found, ""
            continue
        rest = page[name.end() : end]
        yield "open", found, rest
        if found in RAW and not rest.endswith("/"):
            if lowered is None:
                lowered = page.lower() if len(page.lower()) == size else page
            end = lowered.find(f"</{found}", at)
            start = at = size if end < 0 else end
    if start < size:
        yield "text", "", page[start:]


class Page:
    """Blocks of a page with their words, tag costs and enclosing article.

    Elements left out by name and those of readers add no text. Elements marked by class are told
    apart by number; whether they count is known when the page has been read.
    """

    def __init__(self, page: str, weights: dict[str, float], default: float) -> None:
        self.blocks: list[Block] = [Block()]
        self.weights, self.default = weights, default
        self.counts: dict[str, list[int]] = {}
        # Name, whether left out (2: readers'), mark, article.
        self.stack: list[tuple[str, int, int, int]] = []
        self.opened: dict[str, int] = {}  # open elements of each name
        self.containers = 0
        self.within = [0]  # the mark around each mark
        self.words = [0]  # words right inside of each mark; 0 is no mark
        self.in_containers = 0
        self.kinds: dict[tuple[str, str], tuple[str, int]] = {}
        for kind, name, rest in events(page):
            if kind == "text":
                self._text(rest)
            elif kind == "open":
                self._open(name, rest)
            else:
                self._close(name)
        self._count_words()

    def _inside(self) -> tuple[int, int, int]:
        return self.stack[-1][1:] if self.stack else (0, 0, 0)

    def _text(self, text: str) -> None:
        out, mark, container = self._inside()
        if out:
            return
        block = self.blocks[-1]
        if not block.pieces:
            block.container = container
        words = len(text.split())
        block.pieces.append((mark, words, text))
        self.words[mark] += words
        if container:
            self.in_containers += words

    def _tag(self, kind: str, name: str, block_tag: bool) -> None:
        weight = self.weights.get(kind)
        if weight is None:
            weight = self.weights.get(name, self.default)
        if block_tag and self.blocks[-1].pieces:
            self.blocks.append(Block())
        self.blocks[-1].cost += weight
        count = self.counts.setdefault(kind, [0, 0])
        count[0 if self._inside()[2] else 1] += 1

    def _open(self, name: str, rest: str) -> None:
        known = self.kinds.get((name, rest))
        if known is None:
            known = self.kinds[name, rest] = tag_kind(name, rest), out_level(name, rest)
        kind, level = known
        if name in SPACING:
            self._text(" ")
        if name in ("p", "li") and self.stack and self.stack[-1][0] == name:
            self._pop(len(self.stack) - 1)  # the end tag may be left out
        out, mark, container = self._inside()
        if name in CONTAINERS and not container and level < READERS and out < READERS:
            # An article is not part of a menu or an advert that was left open before it.
            out = mark = 0
            self.containers += 1
            container = self.containers
        if name not in VOID and not rest.endswith("/"):
            out = max(out, int(name in LEFT_OUT), level if level == READERS else 0)
            if level == 1 and not out:
                self.within.append(mark)
                self.words.append(0)
                mark = len(self.words) - 1
            self.stack.append((name, out, mark, container))
            self.opened[name] = self.opened.get(name, 0) + 1
        self._tag(kind, name, name in BLOCKS)

    def _pop(self, first: int) -> None:
        for name, *_ in self.stack[first:]:
            self.opened[name] -= 1
        del self.stack[first:]

    def _close(self, name: str) -> None:
        if self.opened.get(name):
            first = len(self.stack) - 1
            while self.stack[first][0] != name:
                first -= 1
            self._tag(name, name, name in BLOCKS)
            self._pop(first)
        elif name in BLOCKS:  # an end tag without a start still ends the block
            self._tag(name, name, True)

    def _count_words(self) -> None:
        """Leave out marked elements, but not one around most words of a page without articles."""
        held = list(self.words)
        for mark in range(len(held) - 1, 0, -1):
            if self.within[mark]:
                held[self.within[mark]] += held[mark]
        total = sum(self.words)
        self.out = [False] * len(held)
        for mark in range(1, len(held)):
            wraps = not self.in_containers and 2 * held[mark] > total
            self.out[mark] = not wraps or self.out[self.within[mark]]
        for block in self.blocks:
            block.words = sum(words for mark, words, _ in block.pieces if not self.out[mark])

    def region(self, word_score: float) -> tuple[int, int]:
        """First block and end of the best contiguous region; the earliest of equal ones."""
        best, best_range = 0.0, (0, 0)
        total, start = 0.0, 0
        for i, block in enumerate(self.blocks):
            total -= block.cost
            if total <= 0.0:
                total, start = 0.0, i
            total += word_score * block.words
            if total > best:
                best, best_range = total, (start, i + 1)
        return best_range

    def text(self, word_score: float) -> str:
        """Main text: the best region with the whole of every article it touches."""
        begin, end = self.region(word_score)
        touched = {block.container for block in self.blocks[begin:end] if block.words} - {0}
        lines = (
            " ".join(html.unescape("".join(self._kept(block))).split())
            for i, block in enumerate(self.blocks)
            if begin <= i < end or block.container in touched
        )
        return "\n".join(line for line in lines if line)

    def _kept(self, block: Block) -> Iterator[str]:
        return (text for mark, _, text in block.pieces if not self.out[mark])


def tag_weights(
    pages: DataFrame, *, page: str = "html", most: int = 5000, outside: float = 10.0
) -> dict[str, float]:
    """Cost of each kind of tag, from all pages that mark an article.

    Counts of each kind inside and outside of articles are summed over all pages; the ``most``
    frequent kinds get the cost 0.05 plus ``outside`` times the share of them that stands outside.
    ``most`` bounds the model: a rarer kind costs what the bare name of its tag does.
    """

    def count(batches):
        import pyarrow as pa

        inside: dict[str, list[int]] = {}
        for batch in batches:
            for data in batch.column("page").to_pylist():
                read = Page(data or "", {}, 0.0)
                if read.containers:
                    for kind, (a, b) in read.counts.items():
                        own = inside.setdefault(kind, [0, 0])
                        own[0] += a
                        own[1] += b
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array(list(inside), pa.string()),
                "inside": pa.array([a for a, _ in inside.values()], pa.int64()),
                "outside": pa.array([b for _, b in inside.values()], pa.int64()),
            }
        )

    counted = (
        pages.select(F.col(page).alias("page"))
        .mapInArrow(count, "kind string, inside long, outside long")
        .groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .orderBy(F.desc(F.col("inside") + F.col("outside")), "kind")
        .limit(most)
        .collect()  # at most ``most`` short rows
    )
    return {
        row["kind"]: 0.05 + outside * (row["outside"] + 1) / (row["inside"] + row["outside"] + 2)
        for row in counted
    }


def main_text(
    pages: DataFrame,
    weights: dict[str, float] | None = None,
    *,
    page: str = "html",
    id_columns: tuple[str, ...] = ("page_id", "url"),
    word_score: float = 1.0,
    default: float = 1.0,
) -> DataFrame:
    """Per input row: id columns, text, n_chars.

    ``text`` is the main text, its blocks joined by one newline, white space inside a block turned
    into one space, character references decoded. Null and empty pages, and pages without words,
    have an empty text. ``weights`` are tag costs (learned from ``pages`` if absent); tags without
    one cost ``default``. Repeated rows stay repeated; other columns are not read.
    """
    if weights is None:
        weights = tag_weights(pages, page=page)

    def make():
        def extract(data: bytes) -> tuple:
            text = Page(data.decode(), weights, default).text(word_score)
            return text, len(text)

        return extract

    fields = {"text": "string", "n_chars": "long"}
    return pages.select(*id_columns, per_text(fields, make)(F.col(page)).alias("_main")).select(
        *id_columns, "_main.text", "_main.n_chars"
    )
