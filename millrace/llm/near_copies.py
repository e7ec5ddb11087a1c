"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of shingles (``SHINGLE`` consecutive words): the count of a shingle
times 1 for one that all documents have, up to 2 for a rare one. Improved consistent weighted
sampling draws (shingle, level) pairs that two documents share with a chance equal to their weighted
Jaccard similarity; bands of samples propose, exact similarities decide. A second set of samples, drawn
with all weights equal, does the same for the plain Jaccard similarity of the different shingles.

=================  ====================================================================================
frequent shingles  two exact passes: a shingle in a share of all documents is in that share of some
                   chunk, so the chunks name candidates, and candidates alone are counted everywhere
exact copies       fall together by a digest of their words; one of each goes on
bands              a bucket links to its smallest document: linear, whatever the bucket's size
refining           the groups so found are compared by samples, in tiles of bounded size; documents
                   that agree in ``LIKELY`` of their samples stay together
deciding           every document is compared exactly with the hub of its group (the one whose buckets
                   are fullest: mostly the text the others were made from); those the hub does not
                   reach are compared with the whole group, again in tiles. Nothing is capped
classes            connected components of the links, as tables
=================  ====================================================================================
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import components, cut, fresh, hold_only, stored
from millrace.llm.decontaminate import words_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
SAMPLES = BANDS * ROWS
#: Share of equal samples below which two documents are not compared exactly; a pair at the similarity of 0.8 is below it once in 10,000 times.
LIKELY = 0.6
#: The weight of every shingle where plain similarities are sampled.
EVEN = 2.0
#: Rows of one side of a tile.
TILE = 128
#: Share of documents from which a shingle's frequency is told; rarer ones weigh alike.
FREQUENT = 1 / 200
#: Frequent shingles that may be broadcast. Where documents are so long that more could exist, the share grows.
MAX_FREQUENT = 500_000
#: Documents of a chunk, and candidates counted in one pass.
CHUNK_DOCS, CANDIDATES = 4_000, 1_000_000
#: Places of the table that tells most shingles from the candidates.
_SIEVE = 1 << 23

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _rolled(words: list[bytes]) -> np.ndarray:
    """The shingles of a text in its order, as numbers. Fewer words than a shingle are one."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    size = min(SHINGLE, len(words))
    many = len(words) - size + 1
    total = np.full(many, size, dtype=np.uint64)
    for k in range(size):
        total *= _PLACES[0]
        total += hashes[k : k + many]
    return _mixed(total)


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of a text, as rising numbers, and their counts."""
    rolled = np.sort(_rolled(words))
    starts = np.flatnonzero(np.append(True, rolled[1:] != rolled[:-1])[: len(rolled)])
    return rolled[starts], np.diff(starts, append=len(rolled))


class Weights:
    """The weight of a shingle: its inverse document frequency, from 1 (in all documents) to 2 (rare)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, documents: int, share: float):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        rarity = np.log(documents / np.maximum(counts[order], 1)) if documents else np.zeros(len(hashes))
        self.idf = 1 + np.minimum(rarity / np.log(1 / share), 1)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        idf = np.full(len(hashes), 2.0)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            idf[known] = self.idf[at[known]]
        return counts * idf


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) at 65,536 even steps, and their logarithms."""
    chance = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros_like(chance), np.full_like(chance, 40.0)
    for _ in range(60):  # bisection of 1 - (1 + x) exp(-x)
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < chance
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low.astype(np.float32), np.log(low).astype(np.float32)


_GAMMA, _LOG_GAMMA = _tables()
#: 1 / r, so that the sampling multiplies instead of dividing.
_INVERSE = 1 / _GAMMA
_SEEDS = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _PLACES[0]) | np.uint64(1)


def samples(hashes: np.ndarray, *weights: np.ndarray, block: int = 512) -> np.ndarray:
    """``SAMPLES`` numbers for each of ``weights``; two weighted sets agree in each with a chance equal to their weighted Jaccard similarity."""
    best = np.full((len(weights), SAMPLES), np.inf, dtype=np.float32)
    chosen, level = np.zeros(best.shape, np.uint64), np.zeros(best.shape, np.float32)
    columns = np.arange(SAMPLES)
    for at in range(0, len(hashes), block):
        part = hashes[at : at + block]
        drawn = part[:, None] * _SEEDS  # shingles are mixed well, so this and one more step will do
        drawn ^= drawn >> np.uint64(29)
        drawn *= _MIX_A
        lanes = drawn.view("<u2").reshape(*drawn.shape, 4)
        index = lanes[..., 3].astype(np.intp)
        r, inverse = _GAMMA.take(index, mode="clip"), _INVERSE.take(index, mode="clip")
        even = lanes[..., 1].astype(np.float32)
        even *= np.float32(1 / 65536)
        last = _LOG_GAMMA.take(lanes[..., 2].astype(np.intp), mode="clip")
        for n, weight in enumerate(weights):  # what is drawn is the same for all
            t = inverse * np.log(weight[at : at + block]).astype(np.float32)[:, None]
            t += even
            np.floor(t, out=t)
            cost = even - t
            cost -= 1
            cost *= r
            cost += last
            first = cost.argmin(axis=0)
            least = cost[first, columns]
            better = least < best[n]
            best[n, better] = least[better]
            chosen[n, better] = part[first[better]]
            level[n, better] = t[first, columns][better]
    return _mixed(chosen ^ _mixed(level.astype(np.int64).view(np.uint64) + _PLACES[1])).ravel()


def similarity(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """The larger of weighted and plain Jaccard similarity of two (hashes, weights)."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = hb[at] == ha
    shared = np.minimum(wa[both], wb[at[both]]).sum()
    weighted = shared / (wa.sum() + wb.sum() - shared)
    n = int(both.sum())
    return max(float(weighted), n / (len(ha) + len(hb) - n))


def _chunk_candidates(share: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only("words")
        held: list[np.ndarray] = []

        def named() -> Iterator[pa.RecordBatch]:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            found = found[counts >= share * len(held)]
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["shingle"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(shingles(words_of(text or ""))[0])
                if len(held) >= CHUNK_DOCS:
                    yield from named()
        if held:
            yield from named()

    return run


def _counted(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only("words")
        wanted = shared.value
        counts = np.zeros(len(wanted), np.int64)
        low = np.uint64(_SIEVE - 1)
        sieve = np.zeros(_SIEVE, bool)
        sieve[(wanted & low).astype(np.intp)] = True
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rolled = _rolled(words_of(text or ""))
                found = rolled[sieve[(rolled & low).view(np.int64)]]  # most are surely none of the wanted ones
                if len(found):
                    at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                    counts[np.unique(at[wanted[at] == found])] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[seen].view(np.int64)), pa.array(counts[seen])], ["shingle", "n"])

    return run


def weigh(texts: DataFrame) -> Weights:
    """Weights by the document frequencies in ``texts`` (one column), exact and over all of them."""
    spark = texts.sparkSession
    column = F.col(texts.columns[0])
    documents, length = texts.agg(F.count("*"), F.sum(F.length(column))).first()
    # A word and the blank after it have two characters at least, so no document has more shingles than half its length.
    share = max(FREQUENT, (length or 0) / 2 / max(documents, 1) / MAX_FREQUENT)
    names = cut(texts.mapInArrow(_chunk_candidates(share), "shingle long").distinct())
    blocks = -(-names.count() // CANDIDATES)
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for block in range(blocks):
        mine = names.where(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == block).toArrow()["shingle"].to_numpy()
        shared = spark.sparkContext.broadcast(np.sort(mine.view(np.uint64)))
        rows = texts.mapInArrow(_counted(shared), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        kept = rows.where(F.col("n") >= share * documents).toArrow()
        hashes.append(kept["shingle"].to_numpy().view(np.uint64))
        counts.append(kept["n"].to_numpy())
    return Weights(np.concatenate(hashes), np.concatenate(counts), documents, share)


def _signed(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_only("words")
        weights = shared.value
        for batch in batches:
            ids, digests, bands, signs = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text or "")
                if not words:
                    continue
                hashes, counts = shingles(words)
                weighed = weights.of(hashes, counts)
                # Even weights are those of rare shingles that come once; such texts are drawn from once.
                alike = (weighed == EVEN).all()
                drawn = np.tile(samples(hashes, weighed), 2) if alike else samples(hashes, weighed, np.full(len(hashes), EVEN))
                ids.append(key)
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                keys = drawn.reshape(2 * BANDS, ROWS)
                with np.errstate(over="ignore"):
                    bands.append(_mixed((keys * _PLACES[:ROWS]).sum(axis=1)).view(np.int64))
                signs.append((drawn & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                ["id", "digest", "bands", "sign"],
            )

    return run


class _Sets:
    """Disjoint sets of row numbers."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _agreement(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Equal samples of every pair, weighted or plain ones, whichever are more."""
    left = np.frombuffer(b"".join(a), np.uint16).reshape(-1, 2, SAMPLES)
    right = np.frombuffer(b"".join(b), np.uint16).reshape(-1, 2, SAMPLES)
    out = np.zeros((2, len(a), len(b)), np.uint8)
    for kind in range(2):
        for k in range(SAMPLES):
            out[kind] += left[:, kind, k, None] == right[None, :, kind, k]
    return out.max(axis=0)


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, run in groupby(rows, key=lambda row: row[:keys]):
        yield key, list(run)


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of tiles (group, i, j, tile, id, sign): links that hold together what agrees in most samples."""
    found = []
    for (_, i, j), rows in _groups(batches, 3):
        left = [r for r in rows if r[3] == i]
        right = left if i == j else [r for r in rows if r[3] == j]
        if not left or not right:
            continue
        sets = _Sets(len(left) + len(right))
        near = np.argwhere(_agreement([r[5] for r in left], [r[5] for r in right]) >= LIKELY * SAMPLES)
        for x, y in near.tolist():
            if left[x][4] != right[y][4] and sets.join(x, y if i == j else len(left) + y):
                found.append((left[x][4], right[y][4]))
        if len(found) > 10_000:
            yield _pairs_batch(found)
            found = []
    yield _pairs_batch(found)


def _with_hub(shared, least: float) -> Callable:
    """Of (id, text, hub, hub's text): the ids that the hub reaches, with the hub."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, hub, hub_set = shared.value, None, None
        for batch in batches:
            linked = []
            for key, text, hub_id, hub_text in zip(*(c.to_pylist() for c in batch.columns)):
                if hub_id != hub:
                    hub, hub_set = hub_id, _weighted(hub_text, weights)
                if key == hub_id or similarity(_weighted(text, weights), hub_set) >= least:
                    linked.append((hub_id, key))
            yield _pairs_batch(linked)

    return run


def _weighted(text: str, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = shingles(words_of(text))
    return hashes, weights.of(hashes, counts)


def _rest(shared, least: float) -> Callable:
    """Of tiles (group, i, j, open, id, hub or null, sign, text): links between open documents and others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for _, rows in _groups(batches, 3):
            unreached, others = [r for r in rows if r[3]], [r for r in rows if not r[3]]
            if not unreached or not others:
                continue
            sets, places, made, found = _Sets(len(rows)), {}, {}, []
            for place, row in enumerate([*unreached, *others]):  # what is known to belong together
                for name in (row[4], ("hub", row[5])) if row[5] is not None else (row[4],):
                    sets.join(place, places.setdefault(name, place))
            agreed = _agreement([r[6] for r in unreached], [r[6] for r in others])
            near = np.argwhere(agreed >= LIKELY * SAMPLES)
            near = near[np.argsort(-agreed[near[:, 0], near[:, 1]].astype(int), kind="stable")]
            for x, y in near.tolist():
                if sets.root(x) != sets.root(len(unreached) + y):
                    for row in (unreached[x], others[y]):
                        if row[4] not in made:
                            made[row[4]] = _weighted(row[7], weights)
                    if similarity(made[unreached[x][4]], made[others[y][4]]) >= least:
                        sets.join(x, len(unreached) + y)
                        found.append((unreached[x][4], others[y][4]))
            yield _pairs_batch(found)

    return run


def _dealt(df: DataFrame) -> DataFrame:
    """Rows with equal (group, i, j) side by side."""
    return df.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")


def _tile_count(rows: Column) -> Column:
    return F.ceil(rows / TILE).cast("int")


def _in_tiles(df: DataFrame, tiles: Column) -> DataFrame:
    """Every row beside every tile of its group: (i, j) with i <= j, and the row's own ``tile``."""
    rows = df.withColumn("tile", F.pmod(F.xxhash64("id"), tiles).cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), tiles - 1)))
    return rows.withColumns({"i": F.least("tile", "k"), "j": F.greatest("tile", "k")})


def _copies(signed: DataFrame, firsts: DataFrame) -> DataFrame:
    """Links from the first of equal word sequences to the others."""
    others = signed.select("digest", F.col("id").alias("b"))
    return others.join(firsts.select("digest", F.col("id").alias("a")), "digest").where(F.col("a") != F.col("b")).select("a", "b")


def _met(firsts: DataFrame) -> DataFrame:
    """(id, lead, n): a document of a bucket with others, the bucket's smallest document and size."""
    places = firsts.select("id", F.posexplode("bands").alias("band", "key"))
    full = cut(places.groupBy("band", "key").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where(F.col("n") > 1))
    return cut(places.join(full, ["band", "key"]).select("id", "lead", "n"))


def _likely_groups(firsts: DataFrame, met: DataFrame) -> DataFrame:
    """(id, group): documents held together by pairs that agree in most samples."""
    coarse = components(met.select("id", "lead").distinct(), "id", "lead")
    rows = cut(coarse.join(firsts.select("id", "sign"), "id").select("id", F.col("label").alias("group"), "sign"))
    sizes = cut(rows.groupBy("group").agg(_tile_count(F.count("*")).alias("tiles")))
    paired = _in_tiles(rows.join(sizes, "group"), F.col("tiles")).select("group", "i", "j", "tile", "id", "sign")
    close = _dealt(paired).mapInArrow(_alike, "a long, b long")
    return components(close).select("id", F.col("label").alias("group"))


def _from_hubs(members: DataFrame, hubs: DataFrame, weights, least: float) -> DataFrame:
    """(a, b): the hub of a group, and a member it reaches (itself too)."""
    texts = members.select(F.col("id").alias("hub"), F.col("text").alias("hub_text"))
    hub_texts = cut(texts.join(hubs, "hub").select("group", "hub", "hub_text"))
    beside = members.select("id", "text", "group").join(hub_texts, "group").select("id", "text", "hub", "hub_text")
    return cut(beside.mapInArrow(_with_hub(weights, least), "a long, b long"))


def _from_others(state: DataFrame, weights, least: float) -> DataFrame:
    """(a, b): links of members that no hub reaches, found by comparing them with their whole group."""
    unreached = F.col("hub").isNull()
    opened = cut(state.where(unreached).groupBy("group").agg(_tile_count(F.count("*")).alias("open_tiles")))
    todo = state.join(opened, "group").withColumn("tiles", _tile_count(F.col("size")))
    spot = F.xxhash64("id")
    left = todo.where(unreached).withColumn("i", F.pmod(spot, F.col("open_tiles")).cast("int"))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("open", F.lit(True))
    right = todo.withColumn("j", F.pmod(spot, F.col("tiles")).cast("int"))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("open_tiles") - 1))).withColumn("open", F.lit(False))
    columns = ["group", "i", "j", "open", "id", "hub", "sign", "text"]
    return _dealt(left.select(columns).unionByName(right.select(columns))).mapInArrow(_rest(weights, least), "a long, b long")


def links(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of document ids whose components are the classes of near copies.

    Every pair is a pair of near copies (or of equal word sequences); not every such pair is listed,
    only enough to hold each class together.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    weights = spark.sparkContext.broadcast(weigh(rows.select("text")))
    signed = stored(rows.mapInArrow(_signed(weights), "id long, digest binary, bands array<long>, sign binary"), "signed")
    firsts = stored(signed.groupBy("digest").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sign").alias("sign")), "firsts")
    met = _met(firsts)
    groups = _likely_groups(firsts, met)
    fullness = met.groupBy("id").agg(F.sum("n").alias("met"))
    named = groups.join(fullness, "id").join(firsts.select("id", "sign"), "id")
    members = stored(named.join(rows, "id").dropDuplicates(["id"]), "members")
    best = F.max(F.struct("met", (-F.col("id")).alias("id")))
    hubs = cut(members.groupBy("group").agg(best.alias("h"), F.count("*").alias("size")).select("group", (-F.col("h.id")).alias("hub"), "size"))
    reached = _from_hubs(members, hubs.select("group", "hub"), weights, least)
    larger = hubs.where(F.col("size") > 2).select("group", "size")
    state = members.join(larger, "group").join(reached.select(F.col("b").alias("id"), F.col("a").alias("hub")), "id", "left")
    rest = _from_others(stored(state.select("group", "size", "id", "hub", "sign", "text"), "state"), weights, least)
    return _copies(signed, firsts).unionByName(reached.where(F.col("a") != F.col("b"))).unionByName(rest)


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Rows (id, class_id): every document that has a near copy, with the smallest id of its class.

    Two documents are near copies if their weighted Jaccard similarity, or the plain one of their
    different shingles, is ``least`` or more; classes are the connected components. A text with
    fewer words than a shingle is one shingle; null texts and texts without words have no copies.
    Rows of one id count as one document, rows without an id as none. Empty tables give empty tables.
    """
    return components(links(docs, id, text, least)).select(F.col("id").alias(id), F.col("label").alias("class_id"))


def first_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id.

    Rows without an id stay; of several rows with one id, one stays. Columns and other rows are unchanged.
    """
    label, key, number = fresh(docs, "class", "key", "number")
    found = classes(docs, id, text, least).select(F.col(id).alias(key), F.col("class_id").alias(label))
    named = docs.where(F.col(id).isNotNull()).join(cut(found), F.col(id) == F.col(key), "left")
    firsts = named.where(F.coalesce(F.col(label), F.col(id)) == F.col(id)).withColumn(number, F.row_number().over(Window.partitionBy(id).orderBy(id)))
    return firsts.where(F.col(number) == 1).select(docs.columns).unionByName(docs.where(F.col(id).isNull()))
