"""Benchmark decontamination with a generalised suffix automaton of the test items.

A window is ``WINDOW`` consecutive words of an item; an item with fewer words (but some) is one
window. The automaton of all items follows a document word by word and always knows the longest
text ending here that occurs in an item. Where that length reaches the window, the last words are a
hit, and the automaton's state names the items; a short item is hit where the followed text ends
with the whole of it. Words no item has put the automaton back to its start, so it only needs to run
over stretches of known words that are long enough for a window: nothing else can match.

Documents stay where they are: no shuffle, one pass. Items are broadcast in blocks of at most
``BLOCK_WORDS`` words; a larger benchmark takes more blocks (and passes over the words of each
document), an item larger than a block is cut into pieces that overlap by a window less one word, so
no window is lost. The driver holds one block at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut, fresh, hold_only

WINDOW = 13
BLOCK_WORDS = 200_000
#: Blocks that one Python pass over the documents may carry, for the memory of a worker.
BLOCKS_AT_ONCE = 2
#: A document is contaminated if hit words are at least one in so many.
ONE_IN = 20

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_AS_WRITTEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that no word has become blanks, A-Z become a-z; bytes of other characters stay.
_FOLD = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of a text: A-Z as a-z, runs of digits, letters and anything beyond ASCII."""
    return text.encode().translate(_FOLD).split()


def places_of_words(text: str) -> list[tuple[int, int]]:
    """Where the words of a text start and end."""
    return [m.span() for m in re.finditer(_WORD_AS_WRITTEN, text)]


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows it has to report."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        sequences = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]) for name, words in items]
        self.base = len(self.vocabulary) + 1
        self.length, self.link, self.edges = [0], [-1], [{}]
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        #: The state of every window, with the items that have it.
        self.window_items: dict[int, set[str]] = {}
        self.whole_items: dict[int, dict[int, set[str]]] = {}  # state: length of a short item: names
        for name, sequence in sequences:
            state = matched = 0
            for word in sequence:
                state, matched = self.step(state, matched, word)
                if len(sequence) >= window and matched >= window:
                    self.window_items.setdefault(self._holding(state, window), set()).add(name)
            if 0 < len(sequence) < window:
                self.whole_items.setdefault(self._holding(state, len(sequence)), {}).setdefault(len(sequence), set()).add(name)
        self.shortest = min((min(len(s), window) for _, s in sequences if s), default=window)
        self._short: dict[int, tuple[tuple[int, int], ...]] = {}

    def _extend(self, last: int, word: int) -> int:
        length, link, edges = self.length, self.link, self.edges
        known = edges[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        edges.append({})
        at = last
        while at >= 0 and word not in edges[at]:
            edges[at][word] = new
            at = link[at]
        if at >= 0:
            target = edges[at][word]
            link[new] = target if length[target] == length[at] + 1 else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        """The part of ``target`` with the shorter texts, as a state of its own."""
        copy = len(self.length)
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[target])
        self.edges.append(dict(self.edges[target]))
        self.link[target] = copy
        while at >= 0 and self.edges[at].get(word) == target:
            self.edges[at][word] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """Follows one word: the state and length of the longest match that ends with it."""
        edges = self.edges
        to = edges[state].get(word)
        if to is not None:
            return to, matched + 1
        while state > 0:
            state = self.link[state]
            to = edges[state].get(word)
            if to is not None:
                return to, self.length[state] + 1
        return 0, 0

    def _holding(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a match of at least that length."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _short_ends(self, state: int) -> tuple[tuple[int, int], ...]:
        """(length, state) of all short items that texts of this state end with."""
        found = self._short.get(state)
        if found is None:
            above = self._short_ends(self.link[state]) if state > 0 else ()
            found = self._short[state] = above + tuple((size, state) for size in self.whole_items.get(state, ()))
        return found

    def hits(self, words: list[bytes], covered: np.ndarray, names: set[str]) -> None:
        """Marks the hit places of ``words`` in ``covered`` and adds the items with occurring windows."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        long_enough = ends - starts >= self.shortest
        for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist()):
            state = matched = 0
            for place, word in enumerate(ids[start:end].tolist(), start):
                state, matched = self.step(state, matched, word)
                if matched >= self.window:
                    owner = self._holding(state, self.window)
                    if owner in self.window_items:
                        covered[place + 1 - self.window : place + 1] = True
                        names.update(self.window_items[owner])
                if self.whole_items:
                    for size, owner in self._short_ends(state):
                        if size <= matched:
                            covered[place + 1 - size : place + 1] = True
                            names.update(self.whole_items[owner][size])


def _stretches(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_automata: dict[str, Automaton] = {}


def worker_automaton(key: str, shared, window: int) -> Automaton:
    """The automaton of a block in this Python worker; at most ``BLOCKS_AT_ONCE`` are kept."""
    if key not in _automata:
        while len(_automata) >= BLOCKS_AT_ONCE:
            del _automata[next(iter(_automata))]
        _automata[key] = Automaton(shared.value, window)
    return _automata[key]


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in blocks of at most ``block_words`` words."""
    piece = block_words // 4 - window + 1
    folded = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), folded.alias("words")).where(F.size("words") > 0).distinct()
    last = F.greatest(F.size("words") - window, F.lit(0))
    pieces = items.select("name", "words", F.explode(F.sequence(F.lit(0), last, F.lit(piece))).alias("at")).select(
        "name", "at", F.slice("words", F.col("at") + 1, F.lit(piece + window - 1)).alias("words")
    )
    pieces = cut(pieces.withColumn("size", F.size("words")))
    total = pieces.agg(F.sum("size")).first()[0] or 0
    count = max(1, ceil(total / block_words))

    def numbered(n: int) -> DataFrame:
        return pieces.withColumn("block", F.pmod(F.xxhash64("name", "at", "words"), F.lit(n)))

    while count > 1 and numbered(count).groupBy("block").agg(F.sum("size").alias("size")).agg(F.max("size")).first()[0] > block_words:
        count *= 2
    for block in range(count):
        rows = numbered(count).where(F.col("block") == block).select("name", "words").collect()
        if rows:
            yield [(r["name"], [w.encode() for w in r["words"]]) for r in rows]


_STATE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _search(key: str, shared, window: int):
    @F.pandas_udf(_STATE)
    def search(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        hold_only("automata")
        automaton = worker_automaton(key, shared, window)
        for texts, before in batches:
            counts, spans, items = [], [], []
            for text, old_spans, old_items in zip(texts, before["spans"], before["items"]):
                words = words_of(text or "")
                covered, names = np.zeros(len(words), dtype=bool), set(old_items)
                for s in old_spans:
                    covered[s["start"] : s["end"]] = True
                automaton.hits(words, covered, names)
                names.discard(None)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in _stretches(covered)])
                items.append(sorted(names))
            yield pd.DataFrame({"n_words": counts, "spans": spans, "items": items})

    return search


def find_overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``df`` with ``n_words``, ``hit_spans`` (ranges of word numbers), ``n_hit``, ``hit_items`` and ``contaminated``.

    Null and empty texts have no words and no hits. Rows stay as they are, also repeated ones, and
    other columns pass through; columns already called like the new ones are replaced. Null and empty
    items have no windows; equal rows of the benchmark count once; an item without an id hits words
    but is not listed. An empty benchmark finds nothing, an empty table gives an empty table.
    """
    (state,) = fresh(df, "overlap")
    nothing = F.struct(
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_STATE["spans"].dataType).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    out, blocks, none = df.withColumn(state, nothing), 0, True
    blocks_of_items = _blocks(benchmark, item_id, item_text, window, block_words)
    for items in chain(blocks_of_items, [[]]):
        if not items and not none:
            break
        none = False
        if blocks and blocks % BLOCKS_AT_ONCE == 0:
            out = cut(out)
        shared = df.sparkSession.sparkContext.broadcast(items)
        out = out.withColumn(state, _search(uuid.uuid4().hex, shared, window)(F.col(text), F.col(state)))
        blocks += 1
    n_hit = F.aggregate(f"{state}.spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    out = out.withColumns({"n_words": F.col(f"{state}.n_words"), "hit_spans": F.col(f"{state}.spans"), "n_hit": n_hit, "hit_items": F.col(f"{state}.items")})
    return out.withColumn("contaminated", contaminated()).drop(state)


def contaminated(one_in: int = ONE_IN) -> Column:
    """Whether hit words are at least one in ``one_in`` of a document's words."""
    return (F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words"))


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, spans):
        if text is None or not len(gone):
            out.append(text)
            continue
        places = places_of_words(text)
        kept, at = [], 0
        for s in gone:
            kept.append(text[at : places[s["start"]][0]])
            at = places[s["end"] - 1][1]
        out.append("".join([*kept, text[at:]]))
    return pd.Series(out, dtype=object)


def remove_overlaps(found: DataFrame, text: str = "text", max_words: int = 0) -> DataFrame:
    """The result of ``find_overlaps`` without contaminated documents, and without hit spans of over ``max_words`` words."""
    long_spans = F.filter("hit_spans", lambda s: s["end"] - s["start"] > max_words)
    return found.where(~F.col("contaminated")).withColumn(text, _without(F.col(text), long_spans))
