"""Toxicity by non-negative positive-unlabelled learning.

Only texts confirmed as toxic and texts nobody has judged are needed. The risk of a classifier is
written with the class prior p as  p * R+(toxic) + max(0, R-(unlabelled) - p * R-(toxic)) : what
unlabelled texts cost as clean ones, less the share that is toxic among them. Where that second part
falls below zero the classifier has begun to learn single texts by heart, and a step goes the other way.

A text is the set of its words and of their beginnings, so inflected forms of a known stem count too.
Features are chosen on the sample by how much more often toxic texts have them. The classifier is a
numpy logistic model, trained on the driver on a sample of bounded size; every whole text is scored
where it lies, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import fresh
from millrace.llm.decontaminate import words_of

#: The bounds of what the driver gathers: confirmed and unlabelled texts (as feature numbers).
CONFIRMED, UNLABELLED = 4_000, 10_000
#: Features of a model.
FEATURES = 1_024
#: Standard deviations that a count of confirmed texts is taken lower when features are chosen.
CAUTION = 1.0
#: Standard deviations by which a feature must be more frequent in confirmed texts than it is anywhere; many features are tried.
CHANCE = 4.0
#: Lengths of word beginnings that are features.
BEGINNINGS = (4, 5, 6)
#: The score from which a text is called toxic.
LEAST = 0.3

_known: dict[bytes, tuple[int, ...]] = {}


def features_of_word(word: bytes) -> tuple[int, ...]:
    """Numbers of a word and of its beginnings."""
    found = _known.get(word)
    if found is None:
        if len(_known) > 100_000:
            _known.clear()
        text = word.decode()
        parts = [f"={text}", *(f"{n}{text[:n]}" for n in BEGINNINGS if len(text) >= n)]
        found = _known[word] = tuple(zlib.crc32(p.encode()) for p in parts)
    return found


def features_of(text: str | None) -> set[int]:
    out: set[int] = set()
    for word in set(words_of((text or "").lower())):
        out.update(features_of_word(word))
    return out


@dataclass
class ToxicModel:
    """Weights by feature number, and the score of a text without any of them before the sigmoid."""

    weights: dict[int, float]
    bias: float

    def score(self, text: str | None) -> float:
        total = self.bias + sum(self.weights.get(f, 0.0) for f in features_of(text))
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def _matrix(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """Which chosen features (rising) each row has."""
    out = np.zeros((len(rows), len(chosen)), dtype=np.float32)
    for n, row in enumerate(rows):
        if len(chosen) and len(row):
            at = np.minimum(np.searchsorted(chosen, row), len(chosen) - 1)
            out[n, at[chosen[at] == row]] = 1
    return out


def _choose(confirmed: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int) -> np.ndarray:
    """The features that most set confirmed texts apart: likely, by a cautious estimate, to mean a toxic text."""
    names, with_c = np.unique(np.concatenate(confirmed), return_counts=True)
    names, with_c = names[with_c >= 3], with_c[with_c >= 3]
    with_u = np.zeros(len(names), np.int64)
    for row in unlabelled if len(names) else []:
        at = np.minimum(np.searchsorted(names, row), len(names) - 1)
        with_u[at[names[at] == row]] += 1
    c, u = max(len(confirmed), 1), max(len(unlabelled), 1)
    share_c, share_u = (with_c + 0.1) / (c + 1), (with_u + 0.5) / (u + 1)
    gain = with_c * np.log(share_c / share_u)
    cautious = np.maximum(with_c - CAUTION * np.sqrt(with_c), 0) / c
    by_chance = c * share_u + CHANCE * np.sqrt(c * share_u)
    good = np.flatnonzero((with_c > by_chance) & (prior * cautious >= LEAST * share_u))
    best = good[np.argsort(-gain[good], kind="stable")[:size]]
    return np.sort(names[best])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(confirmed: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int = FEATURES, steps: int = 800, rate: float = 0.05, decay: float = 2e-4, seed: int = 5) -> ToxicModel:
    """A model by the non-negative risk estimator, from feature numbers of texts."""
    start = float(np.log(max(prior, 1e-4) / (1 - min(prior, 0.9))))
    if not confirmed or not unlabelled or prior <= 0:
        return ToxicModel({}, min(start, -3.0))
    chosen = _choose(confirmed, unlabelled, prior, size)
    x_c, x_u = _matrix(confirmed, chosen), _matrix(unlabelled, chosen)
    rng = np.random.default_rng(seed)
    w = np.zeros(len(chosen) + 1)
    w[-1] = start
    first, second = np.zeros_like(w), np.zeros_like(w)

    def slope(x: np.ndarray, by: np.ndarray) -> np.ndarray:
        return np.concatenate([x.T @ by.astype(np.float32), [by.sum()]])

    for n in range(1, steps + 1):
        c, u = x_c[rng.integers(0, len(x_c), 256)], x_u[rng.integers(0, len(x_u), 768)]
        g_c, g_u = c @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        clean = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_c).mean()
        for_toxic = slope(c, -prior * _sigmoid(-g_c) / len(c))
        for_clean = slope(u, _sigmoid(g_u) / len(u)) - slope(c, prior * _sigmoid(g_c) / len(c))
        gradient = for_toxic + for_clean if clean >= 0 else -for_clean
        gradient[:-1] += decay * w[:-1]
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient * gradient - second)
        speed = rate * (1 - n / (steps + 1)) * np.sqrt(1 - 0.999**n) / (1 - 0.9**n)
        w -= speed * first / (np.sqrt(second) + 1e-8)
    return ToxicModel({int(f): float(v) for f, v in zip(chosen, w[:-1])}, float(w[-1]))


@F.pandas_udf(T.BinaryType())
def _features(texts: pd.Series) -> pd.Series:
    """Rising feature numbers, four bytes each."""
    return pd.Series([np.sort(np.fromiter(features_of(t), dtype=np.uint32)).tobytes() for t in texts], dtype=object)


def _gathered(texts: DataFrame, text: str, most: int) -> list[np.ndarray]:
    """Features of at most ``most`` texts, the first by a hash of the text."""
    order = F.xxhash64(text)
    rows = texts.orderBy(order, text).limit(most).select(_features(F.col(text)).alias("f"))
    return [np.frombuffer(v, dtype=np.uint32) for v in rows.toArrow()["f"].to_pylist()]


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", prior: float | None = None) -> ToxicModel:
    """A model from ``docs`` (unlabelled texts) and those of them that ``labels`` confirm as toxic.

    ``prior`` is the share of toxic texts; by default that among labelled rows. Labels of documents
    that are not in ``docs`` are not used. With several labels for one id the largest counts.
    """
    judged = labels.where(F.col(id).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(id).alias("_judged")).agg(F.max(toxic).alias("_toxic"))
    n, positive = judged.agg(F.count("*"), F.sum((F.col("_toxic") == 1).cast("long"))).first()
    share = (positive or 0) / n if n else 0.0
    # Ids are chosen first and are few by the limit, so that no text moves for them.
    some = judged.where(F.col("_toxic") == 1).orderBy(F.xxhash64("_judged"), "_judged").limit(CONFIRMED).select("_judged")
    confirmed = docs.select(id, text).join(F.broadcast(some), F.col(id) == F.col("_judged")).where(F.col(text).isNotNull())
    count = docs.where(F.col(text).isNotNull()).count()
    chance = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / F.lit(float(1 << 30))
    unlabelled = docs.select(text).where(F.col(text).isNotNull() & (chance <= 1.2 * UNLABELLED / max(count, 1)))
    return fit(_gathered(confirmed.select(text), text, CONFIRMED), _gathered(unlabelled, text, UNLABELLED), share if prior is None else prior)


def predict(df: DataFrame, model: ToxicModel, text: str = "text", score: str = "score", predicted: str = "predicted", least: float = LEAST) -> DataFrame:
    """``df`` with the chance that a whole text is toxic (0 to 1), and 1 where it is at least ``least``, else 0.

    Null and empty texts have the score of a text without features. Rows stay as they are, also
    repeated ones (equal texts get equal scores); other columns pass through and columns already
    called like the new ones are replaced. An empty table gives an empty table.
    """

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.score(t) for t in batch], dtype=np.float64)

    (held,) = fresh(df, "score")
    return df.withColumn(held, scored(F.col(text))).withColumns({score: F.col(held), predicted: (F.col(held) >= least).cast("int")}).drop(held)
