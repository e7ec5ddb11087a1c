"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Every vector is scaled to length one and rounded to int8 codes with a scale of its own; the length of
what rounding took away is kept. The product of two code vectors, times their scales, is then wrong by
at most e + f + e * f for lost lengths e and f, so a pair is settled by its codes unless the bound
leaves the threshold possible both ways. Only such pairs are computed again in double precision.

Equal vectors are collapsed first and counted. The rest are dealt into tiles of about ``TILE`` rows;
every pair of tiles is one independent piece of work of bounded memory, which gives back counts of
links and a spanning forest of them instead of pairs. Each vector is sent to every tile once: all
pairs of n vectors are compared, as they must be for no link to be lost, so work grows as n squared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, cut

THRESHOLD = 0.95
TILE = 4_096
#: Rows and columns of one product.
PATCH = 1_024
#: Pairs computed again at once.
AGAIN = 1 << 15
#: Room for rounding in float32 scaling and in the norms.
_SLACK = 1e-5


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (int8), scales and lost lengths of unit vectors (float64 rows)."""
    scales = np.maximum(np.abs(vectors).max(axis=1), 1e-300) / 127
    codes = np.rint(vectors / scales[:, None]).astype(np.int8)
    lost = np.linalg.norm(vectors - codes * scales[:, None], axis=1)
    return codes, scales, lost


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products of two sets of code vectors. Every sum is a whole number that the type holds exactly."""
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return a.astype(kind) @ b.astype(kind).T


class Tile:
    """Rows of one tile: ids, how many vectors each stands for, unit vectors and their codes."""

    def __init__(self, ids: list[int], copies: list[int], data: list[bytes]):
        self.ids = np.array(ids, dtype=np.int64)
        self.copies = np.array(copies, dtype=np.int64)
        self.raw = np.frombuffer(b"".join(data), dtype=np.float64).reshape(len(ids), -1)
        self.norms = np.linalg.norm(self.raw, axis=1)
        self.codes, self.scales, self.lost = quantise(self.raw / self.norms[:, None])

    def __len__(self) -> int:
        return len(self.ids)


def linked(a: Tile, b: Tile, rows: slice, columns: slice, threshold: float) -> np.ndarray:
    """Which pairs of a patch have a cosine of at least ``threshold``."""
    near = products(a.codes[rows], b.codes[columns]) * a.scales[rows, None] * b.scales[None, columns]
    e, f = a.lost[rows], b.lost[columns]
    widest = e.max() + f.max() + e.max() * f.max() + _SLACK
    out = near >= threshold + widest
    x, y = np.nonzero((near >= threshold - widest) & ~out)
    bound = e[x] + f[y] + e[x] * f[y] + _SLACK
    above = near[x, y] >= threshold + bound
    out[x[above], y[above]] = True
    open_ = ~above & (near[x, y] >= threshold - bound)
    x, y = x[open_], y[open_]
    left, right = a.raw[rows], b.raw[columns]
    for at in range(0, len(x), AGAIN):
        i, j = x[at : at + AGAIN], y[at : at + AGAIN]
        exact = np.einsum("nd,nd->n", left[i], right[j]) / (a.norms[rows][i] * b.norms[columns][j])
        keep = exact >= threshold
        out[i[keep], j[keep]] = True
    return out


def _compare(a: Tile, b: Tile, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of every row of ``a``, of every row of ``b``, and a forest that holds linked rows together."""
    of_a, of_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    labels = np.arange(len(a)) if same else np.arange(len(a) + len(b))
    shift = 0 if same else len(a)
    forest: list[tuple[int, int]] = []
    for top in range(0, len(a), PATCH):
        for left in range(top if same else 0, len(b), PATCH):
            rows, columns = slice(top, min(top + PATCH, len(a))), slice(left, min(left + PATCH, len(b)))
            found = linked(a, b, rows, columns, threshold)
            if same and top == left:
                np.fill_diagonal(found, False)
            if not found.any():
                continue
            of_a[rows] += found @ b.copies[columns]
            if not same or top != left:
                of_b[columns] += a.copies[rows] @ found
            for i in np.flatnonzero(found.any(axis=1)):
                others = np.flatnonzero(found[i]) + left
                met, first = np.unique(labels[others + shift], return_index=True)
                mine = labels[i + top]
                for label, k in zip(met.tolist(), first.tolist()):
                    if label != mine:
                        labels[labels == label] = mine
                        forest.append((int(a.ids[i + top]), int(b.ids[others[k]])))
    return of_a, of_b, forest


def _tiles(threshold: float) -> Callable:
    """Of (size, i, j, tile, id, copies, data): counts (0, id, links) and forest links (1, a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (_, i, j), group in groupby(rows, key=lambda r: r[:3]):
            parts: dict[int, tuple[list, list, list]] = {}
            for row in group:
                for column, value in zip(parts.setdefault(row[3], ([], [], [])), row[4:]):
                    column.append(value)
            if i not in parts or j not in parts:
                continue
            a = Tile(*parts.pop(i))
            b = a if i == j else Tile(*parts.pop(j))
            of_a, of_b, forest = _compare(a, b, i == j, threshold)
            if i == j:
                of_a, of_b = of_a + of_b, of_b[:0]
            ids = np.concatenate([a.ids, b.ids if i != j else b.ids[:0]])
            counts = np.concatenate([of_a, of_b])
            seen = np.flatnonzero(counts)
            x = np.concatenate([ids[seen], np.array([p[0] for p in forest], dtype=np.int64)])
            y = np.concatenate([counts[seen], np.array([p[1] for p in forest], dtype=np.int64)])
            kind = np.repeat(np.array([0, 1], dtype=np.int32), [len(seen), len(forest)])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(x), pa.array(y)], ["kind", "x", "y"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, copies, vector) with the vector as bytes of doubles."""
    for batch in batches:
        data = [np.array(v, dtype=np.float64).tobytes() for v in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["id", "copies", "data"])


def usable(vector: str) -> Column:
    """Whether a vector has only finite components, and not only zeros."""
    value = F.col(vector)
    odd = F.exists(value, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(value.isNotNull() & ~odd & F.exists(value, lambda c: c != 0), F.lit(False))


def near_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (id, n_links, component_id, kept) for the vectors of ``df``.

    ``n_links`` counts other vectors with a cosine of at least ``threshold`` in double precision,
    ``component_id`` is the smallest id that links reach, ``kept`` says that it is the vector's own.
    Vectors that are null, zero or have null or non-finite components link with nothing, nor do
    vectors of different lengths with each other. Rows of one id count as one vector (the first in the
    order of arrays); rows without an id link with nothing and give one row each, kept, without a
    component. Other columns are not read. An empty table gives an empty table.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    named = cut(rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("v").alias("v")))
    good = named.where(usable("v"))
    # Components that say 0.0 and -0.0 are equal; adding zero makes them one key.
    good = cut(good.withColumn("v", F.transform("v", lambda c: c + F.lit(0.0))))
    firsts = cut(good.groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("copies")))
    packed = firsts.select(F.col("first").alias("id"), "copies", "v").mapInArrow(_packed, "id long, copies long, data binary")
    packed = packed.withColumn("size", F.octet_length("data"))
    sizes = cut(firsts.groupBy((F.size("v") * 8).alias("size")).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")))
    dealt = packed.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, "size")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("size", F.least("tile", "k").alias("i"), F.greatest("tile", "k").alias("j"), "tile", "id", "copies", "data")
    sorted_ = dealt.repartition("size", "i", "j").sortWithinPartitions("size", "i", "j")
    found = cut(sorted_.mapInArrow(_tiles(threshold), "kind int, x long, y long"))
    counts = found.where(F.col("kind") == 0).groupBy(F.col("x").alias("first")).agg(F.sum("y").alias("links"))
    labels = components(found.where(F.col("kind") == 1), "x", "y").select(F.col("id").alias("first"), "label")
    of_first = cut(firsts.join(counts, "first", "left").join(labels, "first", "left"))
    owned = good.join(of_first, "v").select(
        "id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("label", "first").alias("label"),
    )
    whole = named.select("id").join(owned, "id", "left")
    answer = whole.select(
        F.col("id").alias(id),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("label", "id").alias("component_id"),
    ).withColumn("kept", F.col("component_id") == F.col(id))
    nameless = rows.where(F.col("id").isNull()).select(
        F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
    )
    return answer.unionByName(nameless)
