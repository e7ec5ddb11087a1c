"""Alignment of two tokenizers over whole documents, and how often their tokens stand for each other.

==========  ===========================================================================================
tokens      A is a byte-level BPE of the ``tokenizers`` library over space + text, B a sentencepiece
            model over the text, which adds that space; each different word is encoded once. Both
            become ends of byte ranges
groups      pointer jumping: every token points to the token farthest to the right that overlaps it (of
            the other tokenizer); pointers are doubled, ``next = next[next]``, until each leads to the
            last token of its component, which names the group. All documents of a run at once
links       pairs of an A and a B token that end together: the last ones of each group
counts      pairs are counted within each document, then over the corpus, combined before they are
            shuffled, and each B id's highest count is found
joining     back to the documents: the most frequent pairs, at most ``FREQUENT``, are looked up where the
            document is (a table of bounded size), the others are joined. So pairs that nearly every document
            holds are never shuffled, and nothing is dropped
==========  ===========================================================================================

Alignment is done once, into a written table of token counts, group digests and pair counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from millrace.llm.bpe_queue import portions
from millrace.llm.common import fresh, stored

#: Most pairs that are looked up in place, three numbers each.
FREQUENT = 200_000
#: Steps by which a count doubles, where the counts of frequent pairs are told from the others.
STEPS = 8
#: Characters whose tokens are aligned at once.
RUN_CHARS = 1_000_000
#: A pair of ids as one number.
SHIFT = 32

#: Chunks of text whose ids a worker remembers, twice: those of late, and those before. How long they may be.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64

_SPACE = "▁"
#: Before a space, not the text's last, that follows a character that is surely none itself: ASCII, or an accented letter.
_BREAKS = re.compile(r"(?<=[!-~\u00C0-\u017F])(?= [\s\S])")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes are themselves, the rest follow at 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, the bytes of every id, and what an id is written as in a group."""

    def __init__(self, model_a: bytes, model_b: bytes):
        self.a = Tokenizer.from_buffer(model_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        letters = byte_letters()
        words = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(words.values(), default=-1) + 1)
        for word, number in words.items():
            self.bytes_a[number] = bytes(letters[c] for c in word)
        self.bytes_b = [self._piece(n) for n in range(self.b.get_piece_size())]
        self.width_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # After an A id a comma or, if it is the group's last, a bar; after a B id a comma or a semicolon.
        many_a, many_b = len(self.bytes_a), len(self.bytes_b)
        self.shown = [f"{n}{mark}" for many, marks in ((many_a, ",|"), (many_b, ",;")) for mark in marks for n in range(many)]
        self.first_b = 2 * many_a
        self.separable = self._separable(model_a)
        self.forget()

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(_SPACE, " ").encode()

    def _separable(self, model_a: bytes) -> bool:
        """Whether both tokenizers treat what lies between two ``_BREAKS`` by itself.

        A does if it is cut by the usual byte-level pattern, in none of whose matches a space follows
        anything but space. B does if no piece has a space after another character, as pieces grow by
        joining neighbours.
        """
        read = json.loads(model_a)
        cut = read.get("pre_tokenizer") or {}
        by_pattern = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        return bool(by_pattern and not read.get("normalizer") and not any(_SPACE in p.lstrip(_SPACE) for p in pieces))

    def forget(self) -> None:
        #: Packed ids of A and of B per chunk; chunks that either does not spell; the same of some time ago.
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.misspelt: set[str] = set()
        self.older = self.known

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks, each of which starts with a space, and tell which of them either does not spell."""
        found_a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        found_b = self.b.encode([c[1:] for c in chunks], num_threads=1)
        wanted = [c.encode() for c in chunks]
        whole, sizes = b"".join(wanted), np.fromiter(map(len, wanted), np.int64, len(wanted))
        for known, found, spelt, widths in zip(self.known, (found_a, found_b), (self.bytes_a, self.bytes_b), (self.width_a, self.width_b)):
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            flat = np.fromiter(chain.from_iterable(found), np.int32)
            reached = np.append(0, np.cumsum(widths[flat]))[ends]
            # Equal as a whole and of equal lengths piece by piece is equal piece by piece.
            if not np.array_equal(reached, np.cumsum(sizes)) or b"".join(map(spelt.__getitem__, flat.tolist())) != whole:
                self.misspelt.update(c for c, w, ids in zip(chunks, wanted, found) if b"".join(map(spelt.__getitem__, ids)) != w)
            packed, ends = flat.tobytes(), (ends * 4).tolist()
            known.update((c, packed[i:j]) for c, i, j in zip(chunks, [0, *ends], ends))

    def _meet(self, chunks: set[str]) -> None:
        """Have the ids of these chunks at hand: known, known before, or encoded now."""
        if len(self.known[0]) >= REMEMBERED:
            self.older, self.known = self.known, ({}, {})
        missing = chunks - self.known[0].keys()
        for known, older in zip(self.known, self.older):
            known.update((c, older[c]) for c in missing & older.keys())
        self._learn(list(missing - self.known[0].keys()))

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both for each text; none at all where either does not spell space + text.

        Where both tokenizers allow it, texts are cut into chunks, mostly words, and each different
        chunk is encoded once; otherwise a text is one chunk.
        """
        split = _BREAKS.split if self.separable else lambda text: [text]
        chunked = [split(" " + text) if text else [] for text in texts]
        here = set().union(*chunked)
        self._meet(here)
        out: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        for chunks in chunked:
            fits = not self.misspelt or self.misspelt.isdisjoint(chunks)
            for listed, known in zip(out, self.known):
                packed = b"".join(map(known.__getitem__, chunks)) if fits else b""
                listed.append(np.frombuffer(packed, np.int32).astype(np.int64))
        for chunk in here:
            if len(chunk) > REMEMBERED_CHARS:
                for known in self.known:
                    del known[chunk]
                self.misspelt.discard(chunk)
        if len(self.misspelt) > REMEMBERED:
            self.forget()
        return out


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each A token, then each B token, the last B token of its group, as an index into ``ends_b``.

    The token farthest to the right that overlaps an A token is the B token around its last byte; for a
    B token it is the A token there, or, where both end together, itself: the group's last. Both
    tokenizers cover the same bytes, so these exist.
    """
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    many = len(ends_a)
    own = np.arange(len(ends_b)) + many
    closed = ends_a[over_b] == ends_b if many else np.zeros(0, bool)
    step = np.concatenate([over_a + many, np.where(closed, own, over_b)])
    while True:
        further = step[step]
        if np.array_equal(further, step):
            return step - many
        step = further


class Aligned:
    """The tokens of several texts, aligned: counts, digests and pairs for each."""

    def __init__(self, pair: Pair, texts: list[str]):
        listed_a, listed_b = pair.tokens(texts)
        self.n_a = np.array([len(x) for x in listed_a], dtype=np.int64)
        self.n_b = np.array([len(x) for x in listed_b], dtype=np.int64)
        a, b = np.concatenate([*listed_a, np.zeros(0, np.int64)]), np.concatenate([*listed_b, np.zeros(0, np.int64)])
        # One run of bytes for all texts: where a text ends, a token of each ends.
        last = terminals(np.cumsum(pair.width_a[a]), np.cumsum(pair.width_b[b]))
        of_a, of_b = last[: len(a)], last[len(a) :]
        closes_a = np.append(of_a[1:] != of_a[:-1], True)[: len(a)]
        closes_b = of_b == np.arange(len(b))
        link_a, link_b = a[closes_a], b[closes_b]
        text_of = np.repeat(np.arange(len(texts)), self.n_b)[closes_b]
        self.links = np.bincount(text_of, minlength=len(texts))
        self.groups = self.links  # every group has one last pair, and every link is one
        self._digests(pair, a, b, closes_a, closes_b)
        self._pairs(link_a << SHIFT | link_b, text_of, len(texts))

    def _digests(self, pair: Pair, a: np.ndarray, b: np.ndarray, closes_a: np.ndarray, closes_b: np.ndarray) -> None:
        """Texts of the groups: A's ids of a group, then B's, each written with the mark that follows it."""
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        before = np.append(0, np.cumsum(np.bincount(group_b, minlength=self.links.sum())))
        upto = np.cumsum(np.bincount(group_a, minlength=self.links.sum()))
        written = np.empty(len(a) + len(b), dtype=np.int64)
        written[np.arange(len(a)) + before[group_a]] = a + np.where(closes_a, len(pair.bytes_a), 0)
        written[np.arange(len(b)) + (upto[group_b] if len(b) else 0)] = pair.first_b + b + np.where(closes_b, len(pair.bytes_b), 0)
        shown, at, self.digests = pair.shown, 0, []
        for many in (self.n_a + self.n_b).tolist():
            line = "".join(map(shown.__getitem__, written[at : at + many].tolist()))
            self.digests.append(hashlib.sha256(line[:-1].encode()).hexdigest() if many else "")
            at += many

    def _pairs(self, codes: np.ndarray, text_of: np.ndarray, texts: int) -> None:
        """The different pairs of each text and how often each is linked there."""
        order = np.lexsort((codes, text_of))
        codes, text_of = codes[order], text_of[order]
        new = np.append(True, (codes[1:] != codes[:-1]) | (text_of[1:] != text_of[:-1]))[: len(codes)]
        starts = np.flatnonzero(new)
        self.codes = codes[starts]
        self.times = np.diff(np.append(starts, len(codes)))
        self.ends = np.append(0, np.cumsum(np.bincount(text_of[starts], minlength=texts)))


_ALIGNED = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
)
_worker_pairs: dict[tuple[str, ...], Pair] = {}


def worker_pair(keys: tuple[str, ...], files: list) -> Pair:
    """The tokenizers of this Python worker; they outlive the task. One thread each, as Spark counts on."""
    if keys not in _worker_pairs:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _worker_pairs[keys] = Pair(*[f.value for f in files])
    return _worker_pairs[keys]


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _struct(found: Aligned) -> pa.Array:
    arrays = [pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.groups, found.links)]
    arrays += [pa.array(found.digests, pa.string()), _lists(found.ends, found.codes), _lists(found.ends, found.times)]
    return pa.StructArray.from_arrays(arrays, _ALIGNED.names)


def _known(table) -> object:
    """A column function: links at their B id's highest count and the sum of counts, of those pairs that ``table`` has; the rest as lists."""
    kind = T.StructType(
        [T.StructField("best", T.LongType()), T.StructField("total", T.LongType())]
        + [T.StructField(name, T.ArrayType(T.LongType())) for name in ("pairs", "times")]
    )

    @F.arrow_udf(kind)
    def look_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        codes, counts, highest = table.value
        for pairs, times in batches:
            flat, many = pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)
            lengths = pairs.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lengths)), lengths)
            at = np.minimum(np.searchsorted(codes, flat), max(len(codes) - 1, 0))
            known = codes[at] == flat if len(codes) else np.zeros(len(flat), bool)
            here, n = at[known], many[known]
            sums = np.zeros((2, len(lengths)), dtype=np.int64)
            np.add.at(sums[0], row[known], n * highest[here])
            np.add.at(sums[1], row[known], n * counts[here])
            ends = np.append(0, np.cumsum(np.bincount(row[~known], minlength=len(lengths))))
            arrays = [pa.array(sums[0]), pa.array(sums[1]), _lists(ends, flat[~known]), _lists(ends, many[~known])]
            yield pa.StructArray.from_arrays(arrays, kind.names)

    return look_up


def _frequent(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair, count and flag of the most frequent pairs: as many levels of counts as hold ``FREQUENT`` pairs at most."""
    least, held = None, 0
    for level, many in sorted(pairs.groupBy("level").count().collect(), reverse=True):
        held += many
        if held > FREQUENT:
            break
        least = level
    top = pairs.where(F.col("level") >= least) if least is not None else pairs.limit(0)
    rows = top.select("pair", "count", "best").toPandas().sort_values("pair")
    return tuple(rows[name].to_numpy(dtype=np.int64) for name in rows.columns)


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Byte offsets where a token of A and one of B both end cut both into groups, written
    ``a1,a2|b1;a3|b2,b3``; a link is an A and a B token that end together. ``count_sum`` adds, over the
    document's links, how many links of all rows hold the same two ids; ``n_best`` counts the links
    whose two ids have the highest such count of their B id, ties included.

    Texts that are null or empty, and those that either tokenizer does not spell as space + text, have
    no tokens: zeros, and the empty text instead of a digest. All rows count, also repeated ones, and
    come out as often; other columns pass through, those called as the new ones are replaced. An empty
    table gives an empty one. Texts are taken whole. The tokenizers' files are sent to the executors.
    """
    spark = df.sparkSession
    files = [spark.sparkContext.broadcast(Path(path).read_bytes()) for path in (path_a, path_b)]
    keys = tuple(hashlib.sha256(f.value).hexdigest() for f in files)

    @F.arrow_udf(_ALIGNED)
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pair = worker_pair(keys, files)
        for batch in batches:
            for run in portions(batch, RUN_CHARS):
                yield _struct(Aligned(pair, [text or "" for text in run]))

    named, row = fresh(df, "aligned", "row")
    new = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kept = [c for c in df.columns if c not in new]
    found = df.withColumn(named, aligned(F.col(text))).select(*kept, named)
    found = stored(found.withColumn(row, F.monotonically_increasing_id()), "alignment")

    def entries(frame: DataFrame, at: str) -> DataFrame:
        listed = frame.select(row, F.explode(F.arrays_zip(F.col(f"{at}.pairs").alias("pair"), F.col(f"{at}.times").alias("times"))).alias("e"))
        return listed.select(row, "e.pair", "e.times")

    counted = entries(found, named).groupBy("pair").agg(F.sum("times").alias("count"))
    # A B id meets no more A ids than there are, so a window over them is of bounded size.
    highest = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))))
    level = F.floor(F.log2("count") * STEPS).cast("int")
    pairs = stored(counted.withColumns({"best": (F.col("count") == highest).cast("long"), "level": level}), "pairs")
    table = spark.sparkContext.broadcast(_frequent(pairs))
    looked, total = fresh(found, "looked", "total")
    part = found.withColumn(looked, _known(table)(F.col(f"{named}.pairs"), F.col(f"{named}.times")))
    rare = entries(part, looked).join(pairs.drop("level"), "pair")
    rare = rare.groupBy(row).agg(F.sum(F.col("times") * F.col("best")).alias("best"), F.sum(F.col("times") * F.col("count")).alias(total))
    rare = rare.select(F.col(row).alias("of_row"), F.struct("best", F.col(total).alias("total")).alias(total))
    both = part.join(rare, F.col(row) == F.col("of_row"), "left")
    sums = lambda name: F.col(f"{looked}.{name}") + F.coalesce(F.col(f"{total}.{name}"), F.lit(0))
    columns = [F.col(f"{named}.{c}").alias(c) for c in new[:4]]
    return both.select(*kept, *columns, sums("best").alias("n_best"), sums("total").alias("count_sum"), F.col(f"{named}.groups_sha256").alias("groups_sha256"))
