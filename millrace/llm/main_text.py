"""Main text of HTML pages by minimum-cut labelling of text blocks.

A page becomes a row of text blocks. A linear classifier on what is known of each block (tags and
names around it, length, links, punctuation) gives the cost of calling it content and the cost of
calling it boilerplate; these are its capacities to the two terminals. Blocks that follow each other,
and more so blocks with the same parent or close ancestors, are joined by edges that it costs to cut.
The minimum cut, found by maximum flow, is the cheapest labelling of the whole page: a short line
between paragraphs goes with them, a lone link list does not. Elements that are never content
(scripts, forms, navigation and the like) are no blocks at all.

No labelled pages exist, so the classifier's weights are stated below and not trained. Pages are
independent rows: no shuffle, and memory for one page at a time.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "script style noscript template svg math canvas iframe object audio video map head title nav footer aside form button select option textarea label fieldset legend dialog menu".split()
)
IN_HEAD = frozenset("base head link meta noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: A block element ends an open paragraph, a list item an open list item, and so on.
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "body": "head"}
BLOCK_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 li dd dt td th figcaption".split())

# Words of class and id names, and of roles.
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus reply replies respond discussion widget pagination pager copyright disclaimer toolbar skip".split()
)
#: Bad only where no good name stands beside them, as in "article-header".
DOUBTFUL_NAMES = frozenset("side aside header form search hidden legal".split())
GOOD_NAMES = frozenset("article content main post story entry body text maintext articlebody".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())

# The classifier: what speaks for content (positive) or against it, in thousandths.
WEIGHTS = {
    "in article or main": 3_000,
    "good name around": 900,
    "bad name around": -9_000,
    "page header": -4_000,
    "prose element": 400,
    "heading": 200,
    "long": 900,  # for each doubling of 8 words, three times at most
    "short": -300,
    "sentence end": 500,
    "mostly links": -2_600,
    "no article on the page": 900,
}
SAME_PARENT, SAME_GRANDPARENT, NEXT = 700, 300, 150

_SPLIT_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")


class _Element:
    __slots__ = ("tag", "parent", "never", "bad", "good", "main", "header")

    def __init__(self, tag: str, parent: _Element | None, attrs: dict[str, str | None]):
        names = {w.lower() for key in ("class", "id") for w in _SPLIT_NAMES.findall(attrs.get(key) or "")} if attrs else set()
        role = (attrs.get("role") or "").lower()
        hidden = "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.I) is not None
        self.tag, self.parent = tag, parent
        self.main = tag in MAIN or role in ("main", "article") or (parent is not None and parent.main)
        self.never = hidden or tag in NEVER or role in BAD_ROLES or (parent is not None and parent.never)
        doubtful = names & DOUBTFUL_NAMES and not names & GOOD_NAMES
        self.bad = (tag not in ("html", "body") and bool(names & BAD_NAMES or doubtful)) or (parent is not None and parent.bad)
        self.good = bool(names & GOOD_NAMES) or (parent is not None and parent.good)
        self.header = (tag == "header" and not self.main) or (parent is not None and parent.header)


class _Block:
    __slots__ = ("element", "text", "linked")

    def __init__(self, element: _Element, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked


class BlockReader(HTMLParser):
    """Collects the text blocks of a page; tolerant of tags that are not closed or close nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = [_Element("", None, {})]
        self.count: Counter[str] = Counter()  # open elements by tag, so that none is looked for in vain
        self.blocks: list[_Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.anchors = 0
        self.articles = False

    def _block_ends(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                element = self.open[-1]
                while element.tag in INLINE and element.parent is not None:
                    element = element.parent
                self.blocks.append(_Block(element, text, self.linked))
        self.parts, self.linked = [], 0

    def _close(self, tags: str, within: frozenset[str]) -> None:
        """Closes the innermost of ``tags`` unless an element of ``within`` lies between."""
        wanted = tags.split()
        if not any(self.count[tag] for tag in wanted):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in wanted:
                self._pop_to(at)
                return
            if self.open[at].tag in within:
                return

    def _pop_to(self, at: int) -> None:
        if any(e.tag not in INLINE for e in self.open[at:]):
            self._block_ends()
        self.anchors -= sum(e.tag == "a" for e in self.open[at:])
        self.count.subtract(e.tag for e in self.open[at:])
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if self.count["head"] and tag not in IN_HEAD:
            self._close("head", frozenset())
        if tag in BLOCK_ENDS_P:
            self._close("p", frozenset(("button", "table", "td", "th", "div", "article", "section")))
        if tag in CLOSES:
            self._close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        if tag not in INLINE:
            self._block_ends()
        if tag in VOID:
            return
        element = _Element(tag, self.open[-1], dict(attrs))
        self.open.append(element)
        self.count[tag] += 1
        self.anchors += tag == "a"
        self.articles |= tag in MAIN and not element.never

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        if self.count[tag]:
            at = next(at for at in range(len(self.open) - 1, 0, -1) if self.open[at].tag == tag)
            self._pop_to(at)
        elif tag not in INLINE:
            self._block_ends()

    def handle_data(self, data: str) -> None:
        if not self.open[-1].never:
            self.parts.append(data)
            if self.anchors:
                self.linked += len(data.split())

    def finish(self) -> None:
        self.close()
        self._block_ends()


def blocks_of(html: str) -> tuple[list[_Block], bool]:
    """The blocks of a page in order, and whether it has an article or main element."""
    reader = BlockReader()
    reader.feed(html)
    reader.finish()
    return reader.blocks, reader.articles


def weigh(block: _Block, articles: bool) -> int:
    """What speaks for content (positive) or boilerplate (negative)."""
    e, words = block.element, len(block.text.split())
    total = WEIGHTS["in article or main"] if e.main else WEIGHTS["no article on the page"] if not articles else -WEIGHTS["in article or main"]
    total += WEIGHTS["good name around"] * e.good + WEIGHTS["bad name around"] * e.bad + WEIGHTS["page header"] * e.header
    total += WEIGHTS["prose element"] * (e.tag in PROSE) + WEIGHTS["heading"] * (e.tag in HEADINGS)
    total += WEIGHTS["long"] * min(3, max(0, (words // 8).bit_length())) + WEIGHTS["short"] * (words < 4)
    total += WEIGHTS["sentence end"] * bool(_ENDS.search(block.text))
    return total + WEIGHTS["mostly links"] * (2 * block.linked > words)


def _edges(blocks: list[_Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges: to the next block, and to the last before it with the same parent or grandparent."""
    edges = []
    last_of: dict[int, int] = {}
    last_of_grand: dict[int, int] = {}
    for n, block in enumerate(blocks):
        parent = block.element.parent
        if n:
            edges.append((n - 1, n, NEXT))
        if parent is not None:
            if id(parent) in last_of:
                edges.append((last_of[id(parent)], n, SAME_PARENT))
            last_of[id(parent)] = n
            if parent.parent is not None:
                if id(parent.parent) in last_of_grand:
                    edges.append((last_of_grand[id(parent.parent)], n, SAME_GRANDPARENT))
                last_of_grand[id(parent.parent)] = n
    return edges


def minimum_cut(weights: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source: the labelling with the least total cost.

    A node with a positive weight has that capacity from the source, one with a negative weight has
    it to the sink. Augmenting paths are shortest ones (breadth first, all from one search at a time);
    flow that has been pushed along an edge can be taken back.
    """
    n = len(weights)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: int, back: int) -> None:
        at[a].append(len(to))
        to.append(b)
        room.append(forth)
        at[b].append(len(to))
        to.append(a)
        room.append(back)

    for node, w in enumerate(weights):
        if w > 0:
            join(source, node, w, 0)
        elif w < 0:
            join(node, sink, -w, 0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue and level[sink] < 0:
            a = queue.popleft()
            for e in at[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[node] >= 0 for node in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                keep = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while turn[a] < len(at[a]):
                e = at[a][turn[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_text(html: str | None) -> str:
    """The content blocks of a page, one to a line."""
    blocks, articles = blocks_of(html or "")
    kept = minimum_cut([weigh(b, articles) for b in blocks], _edges(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of every whole page.

    Character references are decoded, white space inside a block is one blank, blocks are joined by
    one line feed in page order. Null and empty pages, and pages without content, have an empty text.
    Unclosed and stray tags are tolerated; an unclosed script or comment reaches to the end. Rows stay
    as they are, also repeated ones; other columns pass through and a column already called ``text``
    is replaced. An empty table gives an empty table.
    """

    @F.pandas_udf(T.StringType())
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    return df.withColumn(text, extracted(F.col(html)))
