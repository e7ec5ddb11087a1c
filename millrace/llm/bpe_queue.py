"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte spans. Every joinable neighbour pair waits in the bucket of its
merge rank; a two-level bitmap over the ranks tells the lowest bucket that is not empty by two
find-first-set steps, whatever the length of the pre-token. A merge does not search the buckets for
pairs it has made invalid: an entry is stale if the pair at its place no longer has that rank, and
is skipped when it comes up. So a pre-token of n bytes takes O(n log n), also without any space.

The work per row is independent: documents stay where they are, no shuffle. The ranks (under one
megabyte, a fixed vocabulary) are read on the driver and broadcast. Each Python worker remembers
pre-tokens in a table of bounded size, which changes no result.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import fresh, hold_only

#: Pre-tokens in each of the two generations that a worker remembers. A matter of speed alone.
REMEMBERED = 250_000
#: Rank files above this size are refused: they are broadcast.
MAX_VOCABULARY = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a base64 token and its rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; the vocabulary is broadcast and may have {MAX_VOCABULARY}")
    return ranks


def piece_encoder(ranks: dict[bytes, int]) -> Callable[[bytes], tuple[int, ...]]:
    """A function from one pre-token to its token ids: always the lowest rank next, leftmost first.

    The queue belongs to the function: it is empty whenever a pre-token is done.
    """
    rank_of = ranks.get
    # The first ranks of a pre-token are those of its byte pairs, looked up by number.
    of_pair = [rank_of(bytes((a, b))) for a in range(256) for b in range(256)]
    buckets: list[list[int] | None] = [None] * (max(ranks.values(), default=0) + 1)
    groups = [0] * ((max(ranks.values(), default=0) >> 8) + 1)  # lower level: 256 ranks to a word
    bits = [1 << k for k in range(max(256, len(groups)))]

    def encode_piece(piece: bytes) -> tuple[int, ...]:
        whole = rank_of(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [of_pair[a << 8 | b] for a, b in zip(piece, piece[1:])]
        waiting.append(None)
        top = 0  # upper level: one bit per word that is not zero
        for place, rank in enumerate(waiting):
            if rank is not None:
                if buckets[rank]:
                    buckets[rank].append(place)  # places rise, so the list is a heap
                else:
                    buckets[rank] = [place]
                    groups[rank >> 8] |= bits[rank & 255]
                    top |= bits[rank >> 8]
        while top:
            group = (top & -top).bit_length() - 1
            word = groups[group]
            bit = word & -word
            rank = (group << 8) + bit.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                place = heappop(bucket)
            else:
                place = bucket[0]
                buckets[rank] = None
                groups[group] = word = word ^ bit
                if not word:
                    top ^= bits[group]
            if waiting[place] != rank:
                continue  # stale
            middle = after[place]
            after[place] = end = after[middle]
            waiting[middle] = None
            if end < n:
                before[end] = place
                waiting[place] = rank = rank_of(piece[place : after[end]])
                if rank is not None:
                    if buckets[rank]:
                        heappush(buckets[rank], place)
                    else:
                        buckets[rank] = [place]
                        groups[rank >> 8] |= bits[rank & 255]
                        top |= bits[rank >> 8]
            else:
                waiting[place] = None
            left = before[place]
            if left >= 0:
                waiting[left] = rank = rank_of(piece[left:end])
                if rank is not None:
                    if buckets[rank]:
                        heappush(buckets[rank], left)
                    else:
                        buckets[rank] = [left]
                        groups[rank >> 8] |= bits[rank & 255]
                        top |= bits[rank >> 8]
        out, place = [], 0
        while place < n:
            end = after[place]
            out.append(ranks[piece[place:end]])
            place = end
        return tuple(out)

    return encode_piece


class Remembering(dict):
    """Pre-token to token ids, packed as four bytes each, worked out when first asked for.

    When full, it becomes the older generation, from which pre-tokens that come again are taken over.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.encode_piece = piece_encoder(ranks)
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.encode_piece(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                super().clear()
            self[piece] = ids
        return ids

    def clear(self) -> None:
        super().clear()
        self.older = {}


class Codec:
    """Text to ids and ids to bytes for one vocabulary and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = regex.compile(pattern).findall
        self.ids = Remembering(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def packed(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        return b"".join(map(self.ids.__getitem__, self.pieces(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def worker_codec(key: str, shared, pattern: str) -> Codec:
    """The codec of this Python worker; it outlives the task, so later tasks find its pre-tokens."""
    if key not in _codecs:
        _codecs[key] = Codec(shared.value, pattern)
    hold_only(f"codec {key}", _codecs[key].ids)
    return _codecs[key]


def portions(batch: pa.Array, chars: int = 2_000_000) -> Iterator[list[str | None]]:
    """A batch of texts in runs of about ``chars``, so that what is made of one stays small.

    Texts become Python's a few at a time: those of a whole batch would lie beside its own copy of them.
    """
    run, size = [], 0
    for at in range(0, len(batch), 64):
        for text in batch.slice(at, 64).to_pylist():
            run.append(text)
            size += len(text or "")
            if size >= chars:
                yield run
                run, size = [], 0
    if run:
        yield run


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the columns ``ids`` (array of int) and ``decoded`` (the bytes that these ids stand for).

    Every match of ``pattern`` is encoded by itself, without special tokens; what the pattern does
    not match (nothing, with the usual ones) is left out. A null text counts as empty: no ids, no
    bytes. Rows stay as they are, also repeated ones; every other column passes through, and
    columns already called ``ids`` or ``decoded`` are replaced. An empty table gives an empty table.
    Texts are taken whole, however long.
    """
    ranks = read_ranks(path)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    key = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("bytes", T.BinaryType())])

    @F.arrow_udf(kind)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = worker_codec(key, shared, pattern)
        for batch in batches:
            for run in portions(batch):
                found = [codec.packed(t) if t else b"" for t in run]
                ends = np.cumsum([0, *map(len, found)]) // 4
                flat = np.frombuffer(b"".join(found), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                back = [codec.decode(np.frombuffer(one, np.int32).tolist()) for one in found]
                yield pa.StructArray.from_arrays([ids, pa.array(back, pa.binary())], ["ids", "bytes"])

    (pair,) = fresh(df, "pair")
    return df.withColumn(pair, both(F.col(text))).withColumns({ids: F.col(f"{pair}.ids"), decoded: F.col(f"{pair}.bytes")}).drop(pair)
