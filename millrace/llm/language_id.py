"""Language identification by a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes that overlap by the widest filter less one, so every
run of bytes a filter can see lies whole in some window. Bytes become short vectors, filters of
several widths slide over them, each filter keeps its maximum over the window, and a softmax layer
turns the maxima into languages. A text's answer is the softmax of its windows' mean scores.

Training is plain numpy (Adam, cross entropy) on a bounded sample of labelled windows; prediction
covers every byte of every text, batch by batch where the rows lie: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import fresh, hold_only

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
BYTE_DIMS = 8
#: Labelled texts that training takes, over all languages in equal parts. A fifth beyond it bounds what the driver gathers.
SAMPLE = 6_000
#: Bytes of a labelled text that a training window is cut from (one window at random from these).
SAMPLE_BYTES = 4_096
#: Bytes that one numpy step handles.
STEP_BYTES = 1 << 17
UNDETERMINED = "und"
#: The chance below which ``accept`` calls a language not determined.
LEAST = 0.3


@dataclass
class ByteCnn:
    """The network's weights. Byte 256 is padding."""

    languages: list[str]
    embed: np.ndarray  # (257, BYTE_DIMS)
    filters: list[np.ndarray]  # per width (width * BYTE_DIMS, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray  # (filters in all, languages)
    out_bias: np.ndarray

    @classmethod
    def untrained(cls, languages: list[str], seed: int) -> ByteCnn:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)
        embed = (rng.standard_normal((257, BYTE_DIMS)) * 0.5).astype(np.float32)
        return cls(
            languages,
            embed,
            [draw(w * BYTE_DIMS, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(FILTERS * len(WIDTHS), len(languages)) * 0.5,
            np.zeros(len(languages), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def maxima(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Of (n, WINDOW) byte numbers: the rectified maximum of every filter, where it lies, and the byte vectors."""
        vectors = self.embed[windows]
        n = len(windows)
        peaks, places = [], []
        for width, filters, bias in zip(WIDTHS, self.filters, self.bias):
            seen = np.lib.stride_tricks.as_strided(
                vectors,
                (n, WINDOW - width + 1, width * BYTE_DIMS),
                (vectors.strides[0], vectors.strides[1], vectors.strides[2]),
                writeable=False,
            )
            felt = seen.reshape(-1, width * BYTE_DIMS) @ filters
            felt = felt.reshape(n, -1, FILTERS)
            places.append(felt.argmax(axis=1) if self._learning else None)
            peaks.append(np.maximum(felt.max(axis=1) + bias, 0))
        return np.concatenate(peaks, axis=1), places, vectors

    _learning = False

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return self.maxima(windows)[0] @ self.out + self.out_bias

    def gradients(self, windows: np.ndarray, answers: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy, in the order of ``weights``."""
        n = len(windows)
        self._learning = True
        peaks, places, vectors = self.maxima(windows)
        self._learning = False
        chance = softmax(peaks @ self.out + self.out_bias)
        chance[np.arange(n), answers] -= 1
        chance /= n
        back = (chance @ self.out.T) * (peaks > 0)
        d_embed = np.zeros_like(self.embed)
        d_filters, d_bias = [], []
        rows = np.arange(n)[:, None, None]
        for k, (width, filters) in enumerate(zip(WIDTHS, self.filters)):
            mine = back[:, k * FILTERS : (k + 1) * FILTERS]
            at = places[k][:, :, None] + np.arange(width)  # (n, FILTERS, width)
            seen = vectors[rows, at].reshape(n, FILTERS, -1)
            d_filters.append(np.einsum("nf,nfd->df", mine, seen))
            d_bias.append(mine.sum(axis=0))
            to_vectors = (mine[:, :, None] * filters.T[None]).reshape(-1, BYTE_DIMS)
            np.add.at(d_embed, windows[rows, at].reshape(-1), to_vectors)
        return [d_embed, *d_filters, *d_bias, peaks.T @ chance, chance.sum(axis=0)]


def softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last padded."""
    step = WINDOW - max(WIDTHS) + 1
    count = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    padded = np.full((count - 1) * step + WINDOW, 256, dtype=np.int16)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (count, WINDOW), (2 * step, 2))


def fit(texts: list[str], languages: list[str], seed: int = 11, steps: int = 400, batch: int = 128, rate: float = 4e-3) -> ByteCnn:
    """A network trained for at least ``steps`` batches; each round takes one random window of every text."""
    names = sorted(set(languages))
    model = ByteCnn.untrained(names, seed)
    answers = np.array([names.index(x) for x in languages])
    rng = np.random.default_rng(seed)
    held = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
    weights = model.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    rounds = -(-steps // -(-len(held) // batch))
    done, total = 0, rounds * -(-len(held) // batch)
    for _ in range(rounds):
        order = rng.permutation(len(held))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            windows = np.full((len(chosen), WINDOW), 256, dtype=np.int16)
            for row, i in enumerate(chosen):
                data = held[i]
                size = WINDOW if rng.random() < 0.7 else int(rng.integers(8, WINDOW))
                start = rng.integers(0, max(1, len(data) - size + 1))
                cut = data[start : start + size]
                if rng.random() < 0.1:  # some texts are all capitals
                    cut = np.frombuffer(cut.tobytes().decode(errors="ignore").upper().encode()[:WINDOW], dtype=np.uint8)
                windows[row, : len(cut)] = cut
            done += 1
            speed = rate * (1 - done / (total + 1)) * np.sqrt(1 - 0.999**done) / (1 - 0.9**done)
            for w, g, m, v in zip(weights, model.gradients(windows, answers[chosen]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (speed * m / (np.sqrt(v) + 1e-8)).astype(w.dtype)
    return model


def quotas(counts: dict[str, int], size: int) -> dict[str, int]:
    """How many rows of each language a sample of ``size`` takes: as many of each, all of those that have fewer."""
    out, left = {}, size
    for rank, (name, many) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[name] = min(many, max(1, left // (len(counts) - rank)))
        left -= out[name]
    return out


def sample(labelled: DataFrame, text: str, lang: str, size: int = SAMPLE) -> tuple[list[str], list[str]]:
    """About ``size`` labelled texts, as many of each language, all of a rare one, chosen by a hash of the text.

    Languages are counted over all rows; the sample follows their counts, so it stays as large
    whatever the table's size. Equal texts fall in or out together; where that brings more than a fifth
    beyond ``size``, the rows that came in most narrowly go. Of more than ``size`` languages each still
    has a row. The driver holds a count per language, as the network has an output for each.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(text).alias("t"), F.col(lang).alias("l"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], []
    wanted = quotas(counts, size)
    # A little more than its quota of each that does not give all, so that few fall short by chance.
    shares = [(name, min(1.0, 1.05 * wanted[name] / n), wanted[name] == n) for name, n in sorted(counts.items())]
    known = rows.sparkSession.createDataFrame(shares, "known string, share double, whole boolean")
    chance = F.pmod(F.xxhash64("t"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    inside = F.substring("t", F.pmod(F.xxhash64("t", F.lit(1)), F.greatest(F.length("t") - SAMPLE_BYTES, F.lit(1))).cast("int") + 1, SAMPLE_BYTES)
    # A row per language, no more than the network has outputs, which every task gets as well.
    named = rows.join(F.broadcast(known), F.col("l") == F.col("known"))
    # Rows of languages taken whole go last, if any do.
    rank = F.when(F.col("whole"), 0.0).otherwise(chance / F.col("share"))
    taken = named.where(F.col("whole") | (chance < F.col("share"))).select(inside.alias("t"), "l", rank.alias("c"))
    most = max(size, len(counts)) * 6 // 5
    got = taken.orderBy("c", "t", "l").limit(most).collect()
    return [r["t"] for r in got], [r["l"] for r in got]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = SAMPLE) -> ByteCnn | None:
    """A network for the languages of ``labelled``; None if no row has a letter and a language."""
    texts, languages = sample(labelled, text, lang, size)
    return fit(texts, languages) if texts else None


def _answers(model: ByteCnn, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The best language and its chance for each text."""
    step = WINDOW - max(WIDTHS) + 1
    totals = np.zeros((len(texts), len(model.languages)))
    counts = np.zeros(len(texts))
    pending: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if pending:
            stacked, owner = np.concatenate(pending), np.concatenate(owners)
            np.add.at(totals, owner, model.logits(stacked))
            counts[:] += np.bincount(owner, minlength=len(texts))
            pending.clear()
            owners.clear()
            held = 0

    per_step = max(1, STEP_BYTES // WINDOW)
    for row, text in enumerate(texts):
        windows = windows_of((text or "").encode())
        for at in range(0, len(windows), per_step):
            piece = windows[at : at + per_step]
            pending.append(piece)
            owners.append(np.full(len(piece), row))
            held += len(piece) * step
            if held >= STEP_BYTES:
                flush()
    flush()
    chances = softmax(totals / np.maximum(counts, 1)[:, None])
    best = chances.argmax(axis=1)
    return [model.languages[k] for k in best], chances[np.arange(len(texts)), best].tolist()


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(df: DataFrame, model: ByteCnn | None, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the likeliest language and its chance (0 to 1) for every whole text.

    Null texts, texts without a letter and all texts of a model that had nothing to learn from are
    ``und`` with score 0. Rows stay as they are, also repeated ones (equal texts get equal answers);
    other columns pass through and columns already called like the new ones are replaced.
    """
    (pair,) = fresh(df, "answer")
    unknown = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        answer = unknown
    else:
        kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

        @F.pandas_udf(kind)
        def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            hold_only("language")
            for batch in batches:
                languages, chances = _answers(model, list(batch))
                yield pd.DataFrame({"lang": languages, "score": chances})

        answer = ask(F.col(text))
    asked = df.withColumn(pair, answer)
    known = F.when(has_letter(text), F.col(pair)).otherwise(unknown)
    return asked.withColumn(pair, known).withColumns({lang_pred: F.col(f"{pair}.lang"), score: F.col(f"{pair}.score")}).drop(pair)


def accept(df: DataFrame, model: ByteCnn | None, least: float = LEAST, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text has a determined language with a chance of at least ``least``."""
    lang, score = fresh(df, "lang", "score")
    judged = predict(df, model, text, lang, score)
    return judged.where((F.col(lang) != UNDETERMINED) & (F.col(score) >= least)).drop(lang, score)
