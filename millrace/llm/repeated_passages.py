"""Passages that repeat across documents, found by collinear chaining of shared k-mer seeds.

=========  ============================================================================================
seeds      of every run of ``SPREAD`` k-mers (``SEED`` words) the one with the smallest hash: two texts
           with the same ``SEED`` + ``SPREAD`` - 1 words share one, whatever surrounds them
links      an occurrence of a shared seed links to that seed's shortest document: linear however many
           documents share it, and the words sent along are never more than the linked document's own
chains     per pair of documents a Fenwick tree over the places in one finds, for each match, the best
           chain that ends before it in both, less the cost of the gap
alignment  chains are walked word by word, gaps aligned and both ends prolonged while words go on agreeing;
           what then has ``PASSAGE`` equal words and few others is a passage
rounds     where shared seeds go on for long but no passage covers them (their shortest documents shared
           only parts), they link again to the next shortest document
windows    where seeds are still not covered after that, every ``PASSAGE`` words in a row are a key of their
           own, which links to its shortest document: that one holds the whole, so no equal run is missed
tiles      seeds that are open even then are met by all pairs of their occurrences, in tiles of bounded size:
           where the words around both (``AROUND`` on either side) have a passage with the seed in it, the shortest
           such document is told; an occurrence without one is compared with all documents that have ``PASSAGE`` words
           in common there, in order. Nothing is capped; looking grows with the square of an open seed's occurrences,
           what is told does not where copies are near enough
=========  ============================================================================================
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import cut, fresh, hold_only, stored
from millrace.llm.decontaminate import _FOLD, places_of_words

SEED, SPREAD = 8, 12
#: Equal words of a passage, and their least share of its length.
PASSAGE, IDENTITY = 50, 0.8
#: What a chain pays for each word that it skips on either side.
GAP_COST = 0.1
#: How often what stays uncovered links again.
ROUNDS = 3
#: Words over which shared seeds must go on, uncovered, to link again: a passage has seeds over at least so many.
STRETCH = PASSAGE - SEED - 2 * SPREAD + 2
#: Words on either side of a seed that are looked at for ``PASSAGE`` words in common.
AROUND = 75
#: Occurrences on one side of a tile, and bits that tell the words around one of them.
TILE, BITS = 2_048, 2_048

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


#: Texts and characters that are hashed at once.
_TEXTS, _CHARACTERS = 128, 1 << 19
_PRIMES = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _xxh64(text: bytes, starts: np.ndarray, size: int) -> np.ndarray:
    """xxh64 of words of one length, below 32 bytes, that start at these places of a text."""
    one, two, three, four, five = _PRIMES
    turned = lambda x, n: x << np.uint64(n) | x >> np.uint64(64 - n)
    total, at = np.full(len(starts), five + np.uint64(size)), 0

    def piece(kind: str, width: int) -> np.ndarray:
        return np.ndarray(len(text) - width + 1, kind, text, 0, (1,))[starts + at].astype(np.uint64)

    while size - at >= 8:
        total = turned(total ^ turned(piece("<u8", 8) * two, 31) * one, 27) * one + four
        at += 8
    if size - at >= 4:
        total = turned(total ^ piece("<u4", 4) * one, 23) * two + three
        at += 4
    while at < size:
        total = turned(total ^ piece("u1", 1) * five, 11) * one
        at += 1
    total = (total ^ total >> np.uint64(33)) * two
    total = (total ^ total >> np.uint64(29)) * three
    return total ^ total >> np.uint64(32)


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts, one text after the other, as 64-bit numbers, and how many each has."""
    parts = [text.encode().translate(_FOLD) for text in texts]
    text = b" ".join([b"", *parts, b""])
    blank = np.frombuffer(text, np.uint8) == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    sizes = np.minimum(ends - starts, 32).astype(np.uint8)
    order = np.argsort(sizes, kind="stable")
    numbers = np.empty(len(starts), np.uint64)
    for size, same in zip(range(32), np.split(order, np.searchsorted(sizes[order], np.arange(1, 33, dtype=np.uint8)))):
        if len(same):
            numbers[same] = _xxh64(text, starts[same], size)
    for n in np.flatnonzero(sizes == 32).tolist():
        numbers[n] = xxhash.xxh64_intdigest(text[starts[n] : ends[n]])
    until = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts], dtype=np.int64))
    return numbers, np.diff(until, prepend=0)


def numbers_of(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of texts as 64-bit numbers, and how many each text has, for some texts at a time."""
    some, long = [], 0
    for text in texts:
        some.append(text or "")
        long += len(some[-1])
        if len(some) == _TEXTS or long >= _CHARACTERS:
            yield _hashed(some)
            some, long = [], 0
    if some:
        yield _hashed(some)


def _rolled(numbers: np.ndarray, size: int) -> np.ndarray:
    """Of every ``size`` numbers in a row the polynomial in ``_FACTOR``, put together from those of 1, 2, 4 ..."""
    power = lambda n: np.uint64(pow(int(_FACTOR), n, 1 << 64))
    part, width, total, done = numbers, 1, numbers[:0], 0
    while True:
        if size & width:  # what is done lies after this part
            total = part[: len(numbers) - width - done + 1] * power(done) + total[width:] if done else part.copy()
            done += width
        if done == size:
            return total
        part = part[:-width] * power(width) + part[width:]
        width *= 2


def _first_smallest(total: np.ndarray, size: int) -> np.ndarray:
    """For every ``size`` values in a row the place of the smallest, the first of equal ones."""
    places, least, width = np.arange(len(total)), total, 1
    while width < size:
        step = min(width, size - width)
        less = least[step:] < least[:-step]
        places = np.where(less, places[step:], places[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    return places


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Hashes of every ``SEED`` numbers in a row."""
    total = _rolled(numbers, SEED)
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(29)
    return total


def seeds_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a text's seeds."""
    many = len(numbers) - SEED + 1
    if many < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    total = _mixed(numbers)
    places = _first_smallest(total, min(SPREAD, many))
    places = places[np.append(True, places[1:] != places[:-1])]
    found = total[places]
    alike = found[1:] == found[:-1]
    if not alike.any():
        return found.view(np.int64), places.astype(np.int32)
    # Where one k-mer follows itself closely (a word said over and over), one in SPREAD places stands for all.
    again = np.append(False, alike & (np.diff(places) < SPREAD))
    starts = np.maximum.accumulate(np.where(again, 0, places))
    step = (places - starts) // SPREAD
    places = places[~again | np.concatenate(([True], step[1:] != step[:-1]))]
    return total[places].view(np.int64), places.astype(np.int32)


def _seeds_of_all(numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one after the other, each of ``PASSAGE`` words at least: hashes, texts and places of the seeds, as ``seeds_of``."""
    total, starts = _mixed(numbers), np.cumsum(sizes) - sizes
    places = _first_smallest(total, SPREAD)
    within = sizes - SEED - SPREAD + 2  # so many k-mers in a row lie in one text
    text = np.repeat(np.arange(len(sizes)), within)
    places = places[np.arange(len(text)) + np.repeat(starts - np.cumsum(within) + within, within)]
    new = np.append(True, (places[1:] != places[:-1]) | (text[1:] != text[:-1]))
    places, text = places[new], text[new]
    found = total[places].view(np.int64)
    places = places - starts[text]
    again = np.unique(text[1:][(found[1:] == found[:-1]) & (text[1:] == text[:-1])])
    if len(again):  # one k-mer follows itself
        kept = ~np.isin(text, again)
        parts = [(found[kept], text[kept], places[kept])]
        for n in again.tolist():
            seeds, at = seeds_of(numbers[starts[n] : starts[n] + sizes[n]])
            parts.append((seeds, np.full(len(seeds), n), at))
        found, text, places = (np.concatenate(c) for c in zip(*parts))
    return found, text, places.astype(np.int32)


def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, text): (seed, id, place, size)."""
    hold_only("passages")
    for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
        seeds, ids, places, sizes = [], [], [], []
        keys, at = batch.column(0).to_numpy(), 0
        for numbers, many in numbers_of(batch.column(1).to_pylist()):
            enough = many >= PASSAGE  # others have no passage, so they must not lead
            if enough.any():
                found, text, place = _seeds_of_all(numbers if enough.all() else numbers[np.repeat(enough, many)], many[enough])
                seeds.append(found)
                places.append(place)
                ids.append(keys[at : at + len(many)][enough][text])
                sizes.append(many[enough][text].astype(np.int32))
            at += len(many)
        columns = [np.concatenate(x) if x else np.zeros(0, k) for x, k in ((seeds, np.int64), (ids, np.int64), (places, np.int32), (sizes, np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["seed", "id", "place", "size"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, text): (id, words as bytes of 32-bit numbers)."""
    for batch in batches:
        words = []
        for numbers, many in numbers_of(batch.column(1).to_pylist()):
            short = (numbers >> np.uint64(32)).astype(np.uint32)
            words += [part.tobytes() for part in np.split(short, np.cumsum(many)[:-1])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], ["id", "words"])


class Fenwick:
    """Prefix maxima of (value, index) over places 0 to ``size`` - 1."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def put(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place]:
                self.best[place] = value
            place += place & -place

    def before(self, place: int) -> tuple[float, int]:
        """The largest value at places below ``place``."""
        top = (float("-inf"), -1)
        while place > 0:
            top = max(top, self.best[place])
            place -= place & -place
        return top


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Collinear chains of seed matches (place in one text, place in the other), the best first.

    A match is worth ``SEED`` words; a chain pays ``GAP_COST`` for every word between the starts of
    its matches beyond a seed's own. Because the cost is linear it can be kept in the value stored,
    and one prefix maximum finds the best predecessor. Every match is in one chain at most.
    """
    matches = sorted(set(matches))
    score, back = [0.0] * len(matches), [-1] * len(matches)
    at = 0
    if all(p[0] < q[0] and p[1] < q[1] for p, q in zip(matches, matches[1:])):
        # In one order in both texts: the best chain before a match ends in the one just before it.
        value = float("-inf")
        for at, (a, b) in enumerate(matches):
            gained = value - GAP_COST * (a + b)
            score[at] = SEED + max(gained, 0.0)
            back[at] = at - 1 if gained > 0 else -1
            value = score[at] + GAP_COST * (a + b)
        at = len(matches)
    else:
        ranks = {b: n for n, b in enumerate(sorted({b for _, b in matches}))}
        tree = Fenwick(len(ranks))
    while at < len(matches):
        end = at
        while end < len(matches) and matches[end][0] == matches[at][0]:
            end += 1
        for n in range(at, end):
            a, b = matches[n]
            value, before = tree.before(ranks[b])
            gained = value - GAP_COST * (a + b)
            score[n] = SEED + max(gained, 0.0)
            back[n] = before if gained > 0 else -1
        for n in range(at, end):  # only now, so that matches at one place do not follow each other
            a, b = matches[n]
            tree.put(ranks[b], (score[n] + GAP_COST * (a + b), n))
        at = end
    used, out = [False] * len(matches), []
    for n in sorted(range(len(matches)), key=lambda n: (-score[n], n)):
        chain = []
        while n >= 0 and not used[n]:
            used[n] = True
            chain.append(matches[n])
            n = back[n]
        if chain:
            out.append(chain[::-1])
    return out


def _equal_between(x: np.ndarray, y: np.ndarray) -> int:
    """Words that two stretches between anchors have in common, in order."""
    if len(x) == len(y):
        return int(np.count_nonzero(x == y))
    return _longest_common(x, y)


def _longest_common(x: np.ndarray, y: np.ndarray) -> int:
    """The length of the longest common subsequence."""
    if not len(x) or not len(y):
        return 0
    return _rises(x.tolist(), _spots(y), len(y))


def _spots(y: np.ndarray) -> dict[int, int]:
    """Of each word of a text its places, as the bits of one number."""
    places: dict[int, int] = {}
    bit = 1
    for word in y.tolist():
        places[word] = places.get(word, 0) | bit
        bit <<= 1
    return places


def _rises(x: list[int], places: dict[int, int], size: int) -> int:
    """The longest common subsequence of words and of a text of ``size`` words by its ``_spots``."""
    # A row of its table as the bits of one number: 0 where the row rises.
    row = full = (1 << size) - 1
    for at in map(places.get, x):
        if at:
            here = row & at
            if here:
                row = (row + here | row - here) & full
    return size - row.bit_count()


#: Words to skip in two texts after a difference, in the order in which they are tried.
_SKIPS = [p for n in range(1, 6) for p in sorted({(n, n), *((k, n - k) for k in range(n + 1))}, key=sum)]


def _prolong(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """How far two texts go on alike from their starts: (words of one, of the other, equal words).

    Equal words count 1, others cost 2; it stops 12 below its best and returns to it. After a
    difference it goes on where three words agree again, with up to five skipped.
    """
    i = j = equal = score = 0
    best = (0, 0, 0, 0)
    in_x, in_y = x.tobytes(), y.tobytes()
    three = 3 * x.itemsize
    size, long_x, long_y = x.itemsize, len(x), len(y)
    while i < long_x and j < long_y:
        at, to = i * size, j * size
        if in_x[at : at + size] == in_y[to : to + size]:
            run = min(long_x - i, long_y - j, 64)
            same = run
            if in_x[at : at + run * size] != in_y[to : to + run * size]:
                same = int((x[i : i + run] != y[j : j + run]).argmax())
            i, j, equal, score = i + same, j + same, equal + same, score + same
            if score > best[0]:
                best = (score, i, j, equal)
            continue
        next_x = [in_x[k : k + three] for k in range(at, at + 6 * size, size)]
        next_y = [in_y[k : k + three] for k in range(to, to + 6 * size, size)]
        if not any(map(next_y.__contains__, next_x)):
            break
        found = next((p for p in _SKIPS if next_x[p[0]] == next_y[p[1]] and len(next_x[p[0]]) == three), None)
        if found is None:
            break
        i, j, score = i + found[0], j + found[1], score - 2 * max(found)
        if score < best[0] - 12:
            break
    return best[1], best[2], best[3]


def _promising(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int]]) -> bool:
    """Whether a chain is long, or the words around it agree often enough to be worth walking."""
    a, b = chain[0]
    span = chain[-1][0] + SEED - a
    if span >= PASSAGE // 2:
        return True
    # Inserted and deleted words move a passage to other diagonals, so a word may have its equal on any of a band.
    before, after, side = min(a, PASSAGE), min(len(x) - a, PASSAGE + span), PASSAGE // 4
    many, first = before + after, b - before - side
    beside = np.full(many + 2 * side, -1)  # no word, where the other text has ended
    low, high = max(first, 0), min(first + len(beside), len(y))
    if low < high:
        beside[low - first : high - first] = y[low:high]
    band = np.ndarray((2 * side + 1, many), beside.dtype, beside, 0, (beside.itemsize, beside.itemsize))
    near = np.logical_or.reduce(band == x[a - before : a + after], axis=0)
    return np.count_nonzero(near) >= PASSAGE // 2


def _walk(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int]], points: list[tuple[int, int, int]] | None = None) -> tuple[int, int, int]:
    """Where a chain ends in both texts, and its equal words: runs of one diagonal at once, gaps by alignment.

    ``points`` gathers (place in one, in the other, equal words so far) wherever equal words begin or end.
    """
    edges = [0, *(n for n in range(1, len(chain)) if chain[n][0] - chain[n][1] != chain[n - 1][0] - chain[n - 1][1]), len(chain)]
    end_a, end_b = chain[0]
    equal = 0
    for first, end in zip(edges, edges[1:]):
        (a, b), last = chain[first], chain[end - 1][0] + SEED
        over = max(end_a - a, end_b - b, 0)
        size = last - a - over
        if size <= 0:
            continue
        between = x[end_a : a + over], y[end_b : b + over]
        if points is not None:  # what goes on from either side belongs to that side
            p, q, more = _prolong(*between)
            points.append((end_a + p, end_b + q, equal + more))
            left_a, left_b, further = _prolong(between[0][p:][::-1], between[1][q:][::-1])
            equal += more + _equal_between(between[0][p : len(between[0]) - left_a], between[1][q : len(between[1]) - left_b])
            points.append((a + over - left_a, b + over - left_b, equal))
            equal += further
        else:
            equal += _equal_between(*between)
        same = x[a + over : last] == y[b + over : b + over + size]
        if points is not None:
            sums = np.concatenate(([0], np.cumsum(same)))
            turns = [0, *(np.flatnonzero(np.diff(same)) + 1).tolist(), size]
            points += [(a + over + k, b + over + k, equal + int(sums[k])) for k in turns]
        equal += int(np.count_nonzero(same))
        end_a, end_b = last, b + over + size
    return end_a, end_b, equal


def _parts(points: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Stretches between points that are passages by themselves, the longest first taken, none within another.

    From one point to a later one ``equal`` less ``IDENTITY`` times the words may fall in neither text. Points are
    taken by rising values in one text; the first place among those no higher in the other is a prefix maximum.
    """
    out, todo = [], [(0, len(points))]
    while todo:
        low, high = todo.pop()
        if high - low < 2 or points[high - 1][2] - points[low][2] < PASSAGE:
            continue
        # Whole numbers, as IDENTITY times words has no exact sums.
        share = round(IDENTITY * 100)
        in_a, in_b = ([100 * points[n][2] - share * points[n][side] for n in range(low, high)] for side in (0, 1))
        ranks = {v: k for k, v in enumerate(sorted(set(in_b)))}
        tree, best = Fenwick(len(ranks)), (0, 0, 0)
        for k in sorted(range(high - low), key=lambda k: (in_a[k], in_b[k], k)):
            tree.put(ranks[in_b[k]], (-k, k))
            first = tree.before(ranks[in_b[k]] + 1)[1]
            best = max(best, (points[low + k][2] - points[low + first][2], low + first, low + k))
        equal, first, last = best
        if equal < PASSAGE:
            continue
        (a, b, _), (end_a, end_b, _) = points[first], points[last]
        out.append((a, end_a, b, end_b, equal))
        todo += [(low, first + 1), (last, high)]
    return out


def _agreed(x: np.ndarray, y: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Those rows (place in one, in the other) from which ``size`` words are equal, in their order."""
    if min(len(x), len(y)) < size:
        return places[:0]
    places = places[(places[:, 0] + size <= len(x)) & (places[:, 1] + size <= len(y))]
    places = places[x[places[:, 0] + size - 1] == y[places[:, 1] + size - 1]]
    x, y = (np.ascontiguousarray(t) for t in (x, y))
    of_x, of_y = (np.ndarray((len(t) - size + 1, size), t.dtype, t, 0, (t.itemsize, t.itemsize)) for t in (x, y))
    return places[np.logical_and.reduce(of_x[places[:, 0]] == of_y[places[:, 1]], axis=1)]


def _true_matches(x: np.ndarray, y: np.ndarray, matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those matches whose words really agree (rows of one id with different texts could have others)."""
    places = _agreed(x, y, np.array(sorted(set(matches)), np.int64).reshape(-1, 2), SEED)
    return list(zip(places[:, 0].tolist(), places[:, 1].tolist()))


def _left_out(x: np.ndarray, y: np.ndarray, matches: list[tuple[int, int]], out: list[tuple[int, int, int, int, int]]) -> Iterator[tuple[int, int]]:
    """Matches of ``PASSAGE`` equal words that together have, in the other text, whatever ``SEED`` of their words no passage of ``out``, which grows, has."""
    equal = _agreed(x, y, np.array(sorted(matches, reverse=True), np.int64).reshape(-1, 2), PASSAGE)
    if not len(equal):
        return
    same = {b: a for a, b in equal.tolist()}
    starts, within = np.array(sorted(same), np.int64), PASSAGE - SEED + 1
    missing = np.zeros(len(y), bool)  # where such SEED words begin
    for b in same:
        missing[b : b + within] = True
    seen = 0
    while True:
        for part in out[seen:]:
            missing[part[2] : part[3] - SEED + 1] = False
        seen = len(out)
        if not missing.any():
            return
        b = int(starts[np.searchsorted(starts, missing.argmax(), side="right") - 1])
        missing[b : b + within] = False
        yield same[b], b


def passages(x: np.ndarray, y: np.ndarray, matches: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end in one; start, end in the other; equal words) that two texts share.

    A match that starts in a passage is taken to be in it. Where ``PASSAGE`` words from a match on are equal and only
    partly in passages (a word said over and over more often in the other text), they are told as well.
    """
    out: list[tuple[int, int, int, int, int]] = []
    if min(len(x), len(y)) < PASSAGE:
        return out
    inside = lambda a, b: any(s <= a < e and t <= b < f for s, e, t, f, _ in out)
    for chain in chains(_true_matches(x, y, matches)):
        chain = [m for m in chain if not inside(*m)] if out else chain
        if not chain or not _promising(x, y, chain):
            continue
        a, b = chain[0]
        end_a, end_b, equal = _walk(x, y, chain)
        whole = _prolonged(x, y, (a, end_a, b, end_b, equal))
        if _is_passage(whole):
            out.append(whole)
            continue
        # Too much that differs lies between its parts: each is judged by itself, with what goes on at both ends.
        start_a, end_a, start_b, end_b, equal = whole
        if equal >= PASSAGE:
            points = [(start_a, start_b, 0)]
            more = _prolong(x[:a][::-1], y[:b][::-1])[2]
            inner: list[tuple[int, int, int]] = []
            walked = _walk(x, y, chain, inner)[2]
            points += [(p, q, more + n) for p, q, n in inner]
            points.append((end_a, end_b, more + walked + _prolong(x[inner[-1][0] :], y[inner[-1][1] :])[2]))
            out += [part for part in (_prolonged(x, y, p) for p in _parts(points)) if _is_passage(part)]
    for a, b in _left_out(x, y, matches, out):
        out.append(_prolonged(x, y, (a, a + PASSAGE, b, b + PASSAGE, PASSAGE)))
    return out


def _prolonged(x: np.ndarray, y: np.ndarray, part: tuple[int, int, int, int, int]) -> tuple[int, int, int, int, int]:
    """(start, end in one; start, end in the other; equal words) with the words that go on alike at both ends."""
    a, end_a, b, end_b, equal = part
    left_a, left_b, more = _prolong(x[:a][::-1], y[:b][::-1])
    right_a, right_b, further = _prolong(x[end_a:], y[end_b:])
    return a - left_a, end_a + right_a, b - left_b, end_b + right_b, equal + more + further


def _whole_parts(x: np.ndarray, y: np.ndarray, parts: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages, seen in a part of both texts, with what goes on alike at both ends; none within another."""
    out: list[tuple[int, int, int, int, int]] = []
    for a, end_a, b, end_b, equal in parts:
        if any(s <= a and end_a <= e and t <= b and end_b <= f for s, e, t, f, _ in out):
            continue
        if _longest_common(x[a:end_a], y[b:end_b]) < equal:  # rows of one id with different texts
            continue
        whole = _prolonged(x, y, (a, end_a, b, end_b, equal))
        out.append(whole if _is_passage(whole) else (a, end_a, b, end_b, equal))
    return out


def _is_passage(part: tuple[int, int, int, int, int]) -> bool:
    a, end_a, b, end_b, equal = part
    return equal >= PASSAGE and equal >= IDENTITY * max(end_a - a, end_b - b)


_FOUND = "a long, a_start int, a_end int, b long, b_start int, b_end int, equal int"


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, places in a, places in b, words of a, words of b) and, where known, parts of passages: the passages."""
    for batch in batches:
        rows = []
        firsts, seconds, at_as, at_bs, xs, ys, *parts = batch.columns
        for n, (a, b) in enumerate(zip(firsts.to_pylist(), seconds.to_pylist())):  # texts one row at a time: a batch of long documents is large
            x, y = (np.frombuffer(c[n].as_buffer(), np.uint32) for c in (xs, ys))
            found = _whole_parts(x, y, [tuple(p.values()) for p in parts[0][n].as_py()]) if parts else []
            at_a, at_b = at_as[n].values, at_bs[n].values
            if at_a is not None and len(at_a):
                found += passages(x, y, list(zip(at_a.to_numpy().tolist(), at_b.to_numpy().tolist())))
            rows += [(a, s, e, b, t, f, n) for s, e, t, f, n in found]
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "a_start", "a_end", "b", "b_start", "b_end", "equal"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, words, places of shared seeds, whether each is open): (seed, id, place, size), a seed for ``PASSAGE`` words.

    Words in a row that two documents share have shared seeds throughout, so only such windows are told,
    and of these the ones with an open seed.
    """
    for batch in batches:
        seeds, ids, places, sizes = [], [], [], []
        keys, texts, at_all, opened_all = batch.columns
        for n, key in enumerate(keys.to_pylist()):  # a row at a time: a document may have very many seeds
            numbers = np.frombuffer(texts[n].as_buffer(), np.uint32)
            many = len(numbers) - PASSAGE + 1
            if many < 1:
                continue
            at, opened = (c[n].values.to_numpy(zero_copy_only=False) for c in (at_all, opened_all))
            order = np.argsort(at, kind="stable")
            at, opened = at[order], opened[order]
            wanted = np.zeros(many, bool)
            for run, of_run in _stretches(at, opened):
                if run[-1] - run[0] < STRETCH:
                    continue
                low, high = max(0, run[0] - 2 * SPREAD), min(many, run[-1] + SEED + 2 * SPREAD - PASSAGE + 1)
                for place in run[of_run].tolist():
                    wanted[max(low, place + SEED - PASSAGE) : max(0, min(high, place + 1))] = True
            chosen = np.flatnonzero(wanted)
            if not len(chosen):
                continue
            total = _rolled(numbers.astype(np.uint64), PASSAGE)
            total ^= total >> np.uint64(31)
            total *= np.uint64(0xBF58476D1CE4E5B9)
            seeds.append((total ^ (total >> np.uint64(29)))[chosen].view(np.int64))
            places.append(chosen.astype(np.int32))
            ids.append(np.full(len(chosen), key, np.int64))
            sizes.append(np.full(len(chosen), len(numbers), np.int32))
        columns = [np.concatenate(x) if x else np.zeros(0, k) for x, k in ((seeds, np.int64), (ids, np.int64), (places, np.int32), (sizes, np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["seed", "id", "place", "size"])


def _stretches(places: np.ndarray, opened: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rising places in runs without long gaps, and which of them are open."""
    breaks = np.flatnonzero(np.diff(places) > 2 * SPREAD) + 1
    return zip(np.split(places, breaks), np.split(opened, breaks))


def _surrounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, words, seeds, their places, whether each is open): (seed, id, size, first, last, open, words around).

    Occurrences of a seed that follow each other closely (a word said over and over) are one row, from the first to the last.
    """
    names = ["seed", "id", "size", "first", "last", "open", "around"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    for batch in batches:
        for n in range(batch.num_rows):  # one row at a time: a document may have very many seeds
            key, words = batch.column(0)[n].as_py(), np.frombuffer(batch.column(1)[n].as_buffer(), np.uint32)
            seeds, places, opened = (c[n].values.to_numpy(zero_copy_only=False) for c in batch.columns[2:])
            order = np.lexsort((places, seeds))
            seeds, places, opened = seeds[order], places[order], opened[order]
            starts = np.flatnonzero(np.append(True, (seeds[1:] != seeds[:-1]) | (np.diff(places) > SPREAD)))
            ends = np.append(starts[1:], len(seeds)) - 1
            runs = zip(seeds[starts].tolist(), places[starts].tolist(), places[ends].tolist(), np.logical_or.reduceat(opened, starts).tolist())
            rows = [(s, key, len(words), p, q, o, words[max(0, p - AROUND) : q + SEED + AROUND].tobytes()) for s, p, q, o in runs]
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 10_000]), kinds)], names)


def _bits(around: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the bits of its words, the second of one word being another bit, and how many bits fell together."""
    sizes = np.fromiter(map(len, around), np.int64, len(around))
    # A text's number before its words, in order.
    both = np.repeat(np.arange(len(around), dtype=np.uint64) << np.uint64(32), sizes) | np.concatenate([*around, np.zeros(0, np.uint32)])
    both.sort()
    row, words = (both >> np.uint64(32)).astype(np.int64), both & np.uint64((1 << 32) - 1)
    new = np.append(True, both[1:] != both[:-1])[: len(both)]
    often = np.arange(len(words)) - np.maximum.accumulate(np.where(new, np.arange(len(words)), 0))
    few = often < PASSAGE  # of one word so many are enough
    row, words, often = row[few], words[few], often[few]
    place = (((words + often.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * _FACTOR) >> np.uint64(40)) % np.uint64(BITS)
    out = np.zeros((len(around), BITS // 64), np.uint64)
    np.bitwise_or.at(out, (row, (place >> np.uint64(6)).astype(np.intp)), np.uint64(1) << (place & np.uint64(63)))
    return out, (np.bincount(row, minlength=len(around)) - np.bitwise_count(out).sum(axis=1)).astype(np.int16)


def _folded(bits: np.ndarray, lost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_bits``, of a quarter as many bits."""
    few = np.bitwise_or.reduce(bits.reshape(len(bits), -1, max(1, BITS // 256)), axis=1)
    return few, (lost + np.bitwise_count(bits).sum(axis=1, dtype=np.int16) - np.bitwise_count(few).sum(axis=1, dtype=np.int16)).astype(np.int16)


def _may_agree(x: np.ndarray, lost: np.ndarray, y: np.ndarray, other_lost: np.ndarray) -> np.ndarray:
    """Of all pairs of two sides whether their bits allow ``PASSAGE`` words in common."""
    common = np.zeros((len(x), len(y)), np.int16)
    for k in range(x.shape[1]):
        common += np.bitwise_count(x[:, k, None] & y[None, :, k])
    # Words that share a bit are told once: as many may be missing as fell together in either.
    common += np.minimum(lost[:, None], other_lost)
    return common >= PASSAGE


def _agreeing(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Pairs of texts that may have ``PASSAGE`` words in common, by the bits of their words: no such pair is missed.

    Most pairs are told apart by a quarter of the bits already.
    """
    sides = [_bits(left), _bits(right)]
    (few, few_lost), (others, others_lost) = (_folded(*side) for side in sides)
    (bits, lost), (other, other_lost) = sides
    for at in range(0, len(left), 128):
        for to in range(0, len(right), 512):
            here, there = slice(at, at + 128), slice(to, to + 512)
            likely = _may_agree(few[here], few_lost[here], others[there], others_lost[there])
            i, j = likely.nonzero()
            if 8 * len(i) > likely.size:
                i, j = _may_agree(bits[here], lost[here], other[there], other_lost[there]).nonzero()
                i, j = i + at, j + to
            else:
                i, j = i + at, j + to
                common = np.bitwise_count(bits[i] & other[j]).sum(axis=1, dtype=np.int64) + np.minimum(lost[i], other_lost[j])
                i, j = i[common >= PASSAGE], j[common >= PASSAGE]
            yield from zip(i.tolist(), j.tolist())


def _grams(words: np.ndarray) -> np.ndarray:
    """Of a text's ``SEED`` words in a row, in order, 40 bits of their hash before 24 for their place."""
    total = _rolled(words.astype(np.uint64), SEED)
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total >> np.uint64(24) << np.uint64(24) | np.arange(len(total), dtype=np.uint64)


def _alike(x: np.ndarray, y: np.ndarray, off: int) -> list[tuple[int, int]]:
    """Matches of ``_grams`` of one text with sorted ones of another: of equal ones that next to ``off`` places further on.

    Of matches that follow each other word by word only the first and the last are told.
    """
    low = np.uint64((1 << 24) - 1)
    wanted = np.minimum(np.maximum(np.arange(off, off + len(x)), 0), int(low))
    sought = (x & ~low) | wanted.astype(np.uint64)
    after = y.searchsorted(sought)
    near = []
    for at in (np.maximum(after - 1, 0), np.minimum(after, len(y) - 1)):
        found = y[at]
        place = (found & low).astype(np.int64)
        near.append((np.where((found ^ sought) <= low, np.abs(place - wanted), 1 << 24), place))
    (far, before), (other, behind) = near
    a = (np.minimum(far, other) < 1 << 24).nonzero()[0]
    b = np.where(far <= other, before, behind)[a]
    edge = np.ones(len(a), bool)
    if len(a) > 2:
        follows = (a[1:] - a[:-1] == 1) & (b[1:] - b[:-1] == 1)
        edge[1:-1] = ~(follows[:-1] & follows[1:])
    return list(zip(a[edge].tolist(), b[edge].tolist()))


def _passage_at(x: np.ndarray, y: np.ndarray, matches: list[tuple[int, int]], last: int) -> tuple[int, int, int, int, int] | None:
    """The passage along the best chain that has the first of ``matches``, if there is one and it goes on to the words at ``last``."""
    first = matches[0]
    chain = next((c for c in chains(_true_matches(x, y, matches)) if first in c), None)
    if chain is None:
        return None
    end_a, end_b, equal = _walk(x, y, chain)
    whole = _prolonged(x, y, (chain[0][0], end_a, chain[0][1], end_b, equal))
    return whole if _is_passage(whole) and whole[0] <= first[0] and last + SEED <= whole[1] else None


_MET = "seed long, own long, spot int, size int, beside long, beside_size int, equal int, at_own array<int>, at_beside array<int>"


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of tiles (seed, i, j, left, id, size, first, last, open, words around), sorted: what an open occurrence on the left meets.

    Where the words around it have a passage with those around another, the seed within, that is told of the shortest such
    document (start and end in both, ``equal`` words), else (``equal`` 0) matches with all that have ``PASSAGE`` words in common.
    """
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for (seed, *_), same in groupby(rows, key=lambda row: row[:3]):
        tile = [row[3:] for row in same]
        sides = [sorted((row[1:] for row in tile if row[0] == side), key=lambda row: (row[1], row[0], row[2])) for side in (True, False)]
        around = [[np.frombuffer(row[5], np.uint32) for row in side] for side in sides]
        grams: list[dict[int, np.ndarray]] = [{}, {}]
        said: dict[int, list[int]] = {}
        spots: dict[int, dict[int, int]] = {}
        met: dict[int, list[tuple]] = {}
        sure = set()
        for x, y in _agreeing(*around):  # of one on the left the shortest first
            a, b = sides[0][x], sides[1][y]
            if x in sure or a[0] == b[0]:
                continue
            words, others = around[0][x], around[1][y]
            if x not in said:
                said = {x: words.tolist()}
            if y not in spots:
                if len(spots) >= TILE // 4:  # they are large
                    spots.clear()
                spots[y] = _spots(others)
            if _rises(said[x], spots[y], len(others)) < PASSAGE:
                continue
            if x not in grams[0]:
                grams[0][x] = _grams(words)
            if y not in grams[1]:
                grams[1][y] = np.sort(_grams(others))
            from_a, from_b = max(0, a[2] - AROUND), max(0, b[2] - AROUND)
            ends = [(a[2] - from_a, b[2] - from_b), (a[3] - from_a, b[3] - from_b)]
            matches = ends + _alike(grams[0][x], grams[1][y], b[2] - from_b - a[2] + from_a)
            within = _passage_at(words, others, matches, a[3] - from_a)
            if within:
                start, end, to, until, equal = within
                sure.add(x)
                met[x] = [(seed, a[0], a[2], a[1], b[0], b[1], equal, [start + from_a, end + from_a], [to + from_b, until + from_b])]
            else:
                met.setdefault(x, []).append((seed, a[0], a[2], a[1], b[0], b[1], 0, [a[2], a[3]], [b[2], b[3]]))
        if met:
            columns = zip(*(row for told in met.values() for row in told))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _MET.split(", ")])


def _led(seeds: DataFrame) -> DataFrame:
    """Seeds that occur again, with place ``at_a`` in document ``a``, the shortest: one shuffle, no row's text read twice."""
    same = Window.partitionBy("seed")
    lead = F.min(F.struct("size", "id", "place")).over(same)
    told = seeds.select("seed", "id", "place", "size", F.count("*").over(same).alias("n"), lead.alias("lead")).where(F.col("n") > 1)
    return told.select("seed", "id", "place", "size", F.col("lead.id").alias("a"), F.col("lead.place").alias("at_a"))


def _linked(shared: DataFrame) -> DataFrame:
    """(a, b, at_a, at_b): the matches of each pair of a seed's shortest document and another."""
    pairs = shared.where(F.col("id") != F.col("a")).groupBy("a", F.col("id").alias("b")).agg(F.collect_list(F.struct("at_a", F.col("place").alias("at_b"))).alias("m"))
    return pairs.select("a", "b", F.col("m.at_a").alias("at_a"), F.col("m.at_b").alias("at_b"))


def _linked_windows(shared: DataFrame) -> DataFrame:
    """As ``_linked``, of windows: one match for those that overlap on one diagonal."""
    lead = shared.groupBy("seed").agg(F.min(F.struct("size", "id", "place")).alias("lead"), (F.min("id") != F.max("id")).alias("of_two")).where("of_two")
    lead = cut(lead.select("seed", F.col("lead.id").alias("a"), F.col("lead.place").alias("at_a")))
    met = shared.join(lead, "seed").where(F.col("id") != F.col("a"))
    near = F.floor(F.col("at_a") / PASSAGE)
    runs = met.groupBy("a", F.col("id").alias("b"), (F.col("place") - F.col("at_a")).alias("off"), near.alias("near")).agg(F.min("at_a").alias("at_a"))
    pairs = runs.groupBy("a", "b").agg(F.collect_list(F.struct("at_a", (F.col("at_a") + F.col("off")).cast("int").alias("at_b"))).alias("m"))
    return pairs.select("a", "b", F.col("m.at_a").alias("at_a"), F.col("m.at_b").alias("at_b"))


def _spans(found: DataFrame) -> DataFrame:
    """(id, s, e, of_b): where passages lie, on either side."""
    sides = F.array(*(F.struct(F.col(k).alias("id"), F.col(f"{k}_start").alias("s"), F.col(f"{k}_end").alias("e"), F.lit(k == "b").alias("of_b")) for k in "ab"))
    return cut(found.select(F.explode(sides).alias("s")).select("s.*").distinct())


def _told(shared: DataFrame, spans: DataFrame) -> DataFrame:
    """``shared`` with ``covered`` and ``linked``: whether one of ``spans`` has the occurrence on either side, and on side ``b``."""
    covers = F.coalesce((F.col("place") >= F.col("s")) & (F.col("place") + SEED <= F.col("e")), F.lit(False))
    linked = F.max(covers & F.coalesce("of_b", F.lit(False)))
    return shared.join(spans, "id", "left").groupBy(shared.columns).agg(F.max(covers).alias("covered"), linked.alias("linked"))


def _told_again(told: DataFrame, spans: DataFrame) -> DataFrame:
    """What ``_told`` told, with further spans: only of what is not known as both is there more to learn."""
    both = F.col("covered") & F.col("linked")
    known = told.where(~both).withColumnsRenamed({"covered": "was_covered", "linked": "was_linked"})
    more = _told(known, spans).withColumns({k: F.col(k) | F.col(f"was_{k}") for k in ("covered", "linked")})
    return told.where(both).unionByName(more.select(told.columns))


def _uncovered(told: DataFrame) -> DataFrame:
    """Occurrences of shared seeds in long stretches that no passage covers, without documents that led already."""
    open_ = cut(told.where((F.col("id") != F.col("a")) & ~F.col("covered")).drop("a", "at_a", "covered", "linked"))
    order = Window.partitionBy("id").orderBy("place")
    far = F.col("place") - F.lag("place").over(order) > 2 * SPREAD
    stretch = F.sum(F.coalesce(far, F.lit(True)).cast("int")).over(order)
    whole = Window.partitionBy("id", "stretch")
    long = F.max("place").over(whole) - F.min("place").over(whole) >= STRETCH
    kept = open_.withColumn("stretch", stretch).withColumn("long", long).where(F.col("long")).drop("stretch", "long")
    return cut(_led(kept))


def _open_windows(words: DataFrame, shared: DataFrame, told: DataFrame) -> DataFrame:
    """(seed, id, place, size) of the windows, in all documents, around seeds that a longer document has uncovered."""
    told = told.where(~F.col("linked"))
    opened = told.where(F.col("id") != F.col("a")).select("seed").distinct().withColumn("open", F.lit(True))
    marked = shared.join(cut(opened), "seed", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    places = marked.groupBy("id").agg(F.collect_list(F.struct("place", "open")).alias("m"), F.max("open").alias("any")).where("any")
    chosen = words.join(cut(places.select("id", F.col("m.place").alias("places"), F.col("m.open").alias("opened"))), "id")
    windows = chosen.select("id", "words", "places", "opened").mapInArrow(_windows, "seed long, id long, place int, size int")
    return windows


def _in_tiles(words: DataFrame, told: DataFrame, still: DataFrame) -> DataFrame:
    """As ``_linked``, of all pairs of documents that share a seed of ``still``, open in one of them, and words around it."""
    of_two = F.min("id") != F.max("id")
    seeds = told.join(still.select("seed").distinct(), "seed", "left_semi").select("seed", "id", "place").distinct()
    several = cut(seeds.groupBy("seed").agg(of_two.alias("of_two")).where("of_two").select("seed"))
    marked = seeds.join(several, "seed", "left_semi").join(still, ["seed", "id", "place"], "left")
    listed = marked.groupBy("id").agg(F.collect_list(F.struct("seed", "place", F.coalesce("open", F.lit(False)).alias("open"))).alias("m"))
    listed = cut(listed.select("id", F.col("m.seed").alias("seeds"), F.col("m.place").alias("places"), F.col("m.open").alias("opened")))
    beside = words.join(listed, "id").select("id", "words", "seeds", "places", "opened")
    around = stored(beside.mapInArrow(_surrounded, "seed long, id long, size int, first int, last int, open boolean, around binary"), "around")
    tiles = lambda many: F.ceil(many / TILE).cast("int")
    sizes = around.groupBy("seed").agg(tiles(F.count("*")).alias("tiles"), tiles(F.count_if("open")).alias("open_tiles"))
    todo = around.join(cut(sizes.where(F.col("open_tiles") > 0)), "seed")
    spot = F.xxhash64("id", "first")
    own = lambda many: F.pmod(spot, F.col(many)).cast("int")
    beside = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    lefts = todo.where("open").withColumn("i", own("open_tiles")).withColumn("j", beside("tiles")).withColumn("left", F.lit(True))
    rights = todo.withColumn("j", own("tiles")).withColumn("i", beside("open_tiles")).withColumn("left", F.lit(False))
    columns = ["seed", "i", "j", "left", "id", "size", "first", "last", "open", "around"]
    dealt = lefts.select(columns).unionByName(rights.select(columns)).repartition("seed", "i", "j").sortWithinPartitions("seed", "i", "j")
    met = dealt.mapInArrow(_meeting, _MET)
    one = Window.partitionBy("seed", "own", "spot")
    place = F.row_number().over(one.orderBy((F.col("equal") > 0).desc(), "beside_size", "beside"))
    met = met.withColumn("most", F.max("equal").over(one)).withColumn("place", place).where((F.col("most") == 0) | (F.col("place") == 1))
    leads = (F.col("size") < F.col("beside_size")) | ((F.col("size") == F.col("beside_size")) & (F.col("own") < F.col("beside")))
    ways = [met.where(way).select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(f"at_{a}").alias("at_a"), F.col(f"at_{b}").alias("at_b"), "equal") for way, a, b in ((leads, "own", "beside"), (~leads, "beside", "own"))]
    matches = F.when(F.col("equal") == 0, F.arrays_zip("at_a", "at_b"))
    ends = [F.col(f"at_{k}")[n].alias(f"{k}_{name}") for k in "ab" for n, name in enumerate(("start", "end"))]
    parts = F.when(F.col("equal") > 0, F.struct(*ends, "equal"))
    told = [F.array_distinct(F.flatten(F.collect_list(matches))).alias("m"), F.array_sort(F.collect_set(parts)).alias("parts")]
    pairs = ways[0].unionByName(ways[1]).groupBy("a", "b").agg(*told)
    return pairs.select("a", "b", F.col("m.at_a").alias("at_a"), F.col("m.at_b").alias("at_b"), "parts")


def _covering(found: DataFrame, still: DataFrame) -> DataFrame:
    """Passages that have an occurrence of ``still`` on either side; what the others hold is told with shorter documents."""
    places = still.groupBy("id").agg(F.array_sort(F.collect_list("place")).alias("places"))
    for k in "ab":
        found = found.join(places.select(F.col("id").alias(k), F.col("places").alias(f"in_{k}")), k, "left")
        found = found.withColumn(f"in_{k}", F.expr(f"coalesce(exists(in_{k}, p -> p >= {k}_start AND p + {SEED} <= {k}_end), false)"))
    return found.where("in_a OR in_b").drop("in_a", "in_b")


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages that two documents share: (a, a_start, a_end, b, b_start, b_end, equal).

    ``a`` is the shorter document; places count words (runs of ASCII letters and digits and of any
    other characters beyond ASCII, case ignored), ends are exclusive; ``equal`` words are the same in
    both. A passage that many documents share is told for each of them with the shortest, not for all
    pairs. Repeats inside one document are not told. Null and short texts have no passages. Rows of one
    id count as one document (which of different texts is open), rows without an id are left out. An
    empty table gives an empty table.
    """
    rows = docs.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    seeds = rows.mapInArrow(_seeded, "seed long, id long, place int, size int")
    shared = stored(_led(seeds), "seeds-shared")
    pairs = stored(_linked(shared), "pairs")
    if pairs.isEmpty():
        return docs.sparkSession.createDataFrame([], _FOUND)
    words = _words(rows, pairs)  # whatever is compared later on has a seed in common as well
    found = [_compared(words, pairs)]
    told = stored(_told(shared, _spans(found[0])), "told")
    left, later = told, []
    for _ in range(ROUNDS - 1):
        open_ = _uncovered(left)
        pairs = stored(_linked(open_), "pairs")
        if pairs.isEmpty():
            break
        found.append(_compared(_narrowed(words, pairs), pairs))
        later.append(_spans(found[-1]))
        left = _told(open_, later[-1])
    if later:
        told = stored(_told_again(told, reduce(DataFrame.unionByName, later)), "told")
    windows = stored(_open_windows(words, shared, told), "windows")
    pairs = stored(_linked_windows(windows), "pairs")
    further = _compared(_narrowed(words, pairs), pairs)
    still = _told(told.where(~F.col("covered")).drop("covered", "linked"), _spans(further)).where(~F.col("covered"))
    still = stored(still.select("seed", "id", "place").withColumn("open", F.lit(True)).distinct(), "still")
    pairs = stored(_in_tiles(words, told, still), "pairs")
    last = _covering(_compared(_narrowed(words, pairs), pairs), still)
    return reduce(DataFrame.unionByName, [*found, further, last]).distinct()


def _of_pairs(pairs: DataFrame) -> DataFrame:
    return stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")


def _words(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, words) of all documents in linked pairs, one row each."""
    chosen = rows.join(_of_pairs(pairs), "id").select("id", "text").dropDuplicates(["id"])
    return stored(chosen.mapInArrow(_numbered, "id long, words binary"), "words")


def _narrowed(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``words`` that some pairs need."""
    return stored(words.join(_of_pairs(pairs), "id"), "words")


def _compared(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """The passages of linked pairs."""
    of_a, of_b = (words.select(F.col("id").alias(k), F.col("words").alias(f"words_{k}")) for k in "ab")
    columns = ["a", "b", "at_a", "at_b", "words_a", "words_b", *(["parts"] if "parts" in pairs.columns else [])]
    beside = pairs.join(of_b, "b").join(of_a, "a").select(columns)
    return stored(beside.mapInArrow(_aligned, _FOUND), "passages")


def per_document(found: DataFrame) -> DataFrame:
    """Rows (id, start, end, twin, twin_start, twin_end, equal, first): every passage from both sides.

    ``first`` marks the side that stays when repeats are removed, that of the shorter document.
    """
    side = lambda x, y, first: F.struct(
        F.col(x).alias("id"), F.col(f"{x}_start").alias("start"), F.col(f"{x}_end").alias("end"),
        F.col(y).alias("twin"), F.col(f"{y}_start").alias("twin_start"), F.col(f"{y}_end").alias("twin_end"), "equal", F.lit(first).alias("first"),
    )
    return found.select(F.explode(F.array(side("a", "b", True), side("b", "a", False))).alias("s")).select("s.*")


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, spans):
        if text is None or gone is None or not len(gone):
            out.append(text)
            continue
        places, kept, at = places_of_words(text), [], 0
        for start, end in sorted((s["start"], s["end"]) for s in gone):
            kept.append(text[at : max(at, places[start][0])])
            at = max(at, places[end - 1][1])
        out.append("".join([*kept, text[at:]]))
    return pd.Series(out, dtype=object)


def without_repeats(docs: DataFrame, found: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the passages of ``found`` that a shorter document has; other columns and rows stay."""
    key, gone = fresh(docs, "key", "gone")
    spans = found.groupBy(F.col("b").alias(key)).agg(F.collect_set(F.struct(F.col("b_start").alias("start"), F.col("b_end").alias("end"))).alias(gone))
    named = docs.join(stored(spans, "spans"), F.col(id) == F.col(key), "left")
    return named.withColumn(text, _without(F.col(text), F.col(gone))).select(docs.columns)
