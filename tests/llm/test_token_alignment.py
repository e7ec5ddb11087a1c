"""Alignment against shared byte ends found one by one."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import queries
from millrace.llm import token_alignment as A

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
OUT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spelt():
    """Bytes of every id, from the two libraries' own decoding of single ids."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    letters = A.byte_letters()
    assert sorted(letters.values()) == list(range(256)) and letters["Ġ"] == 32 and letters["Ċ"] == 10
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    of_a = {n: bytes(letters[c] for c in w) for w, n in a.get_vocab(False).items()}

    def of_b(n):
        piece = b.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(n) else piece.replace("▁", " ").encode()

    return a, b, of_a.__getitem__, of_b


def groups(text, kit):
    a, b, of_a, of_b = kit
    if not text:
        return []
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    if any(b"".join(map(of, i)) != (" " + text).encode() for i, of in zip(ids, (of_a, of_b))):
        return []
    ends = [np.cumsum([len(of(n)) for n in i]).tolist() for i, of in zip(ids, (of_a, of_b))]
    out, starts = [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        stops = [ends[side].index(cut, starts[side]) + 1 for side in (0, 1)]
        out.append(tuple(ids[side][starts[side] : stops[side]] for side in (0, 1)))
        starts = stops
    return out


def brute(texts):
    kit = spelt()
    found = [groups(text, kit) for text in texts]
    links = [[(a[-1], b[-1]) for a, b in g] for g in found]
    counts = Counter(pair for one in links for pair in one)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    rows = []
    for g, one in zip(found, links):
        said = ";".join("|".join(",".join(map(str, side)) for side in pair) for pair in g)
        rows.append(
            (
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                len(one),
                sum(counts[p] == highest[p[1]] for p in one),
                sum(counts[p] for p in one),
                hashlib.sha256(said.encode()).hexdigest() if g else "",
            )
        )
    return rows


TEXTS = [
    None,
    "",
    " ",
    "a",
    "hello world, hello  worlds\n\n\tand tokenization of <|endoftext|> and <s>unk</s>",
    "antidisestablishmentarianism " * 40,
    "a ▁ piece that stands for a space",
    "<0x41> and <0x0A>",
    "été à l'école, Straße 𝒳🎉👩‍👩‍👧 \x00 \x7f ﬁ   \xa0",
    "日本語のテキスト 中文 한국어",
    "   leading and trailing   ",
    "hello world",
    "hello world",
    "x" * 3_000 + " " * 500 + "\n" * 70,
]


def aligned(spark, texts, parts=3):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = frame.selectExpr("doc_id", "text", "'old' AS n_a", "doc_id AS aligned", "doc_id AS _row", "1 AS pair").repartition(parts)
    rows = A.align(frame, *PATHS).collect()
    assert sorted(rows[0].asDict()) == sorted(["doc_id", "text", "aligned", "_row", "pair", *OUT])
    assert all(r["aligned"] == r["doc_id"] for r in rows)
    return [tuple(r[c] for c in OUT) for r in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("frequent", [200_000, 30, 0])
def test_against_shared_ends(spark, monkeypatch, frequent):
    """Wherever the counts of a pair come from: looked up in place, joined, or some of each."""
    monkeypatch.setattr(A, "FREQUENT", frequent)
    assert aligned(spark, TEXTS) == brute(TEXTS)


def test_chunks_are_encoded_as_whole_texts_are(monkeypatch):
    """Against the libraries on whole texts, with few remembered chunks and with none."""
    pair = A.Pair(*[Path(p).read_bytes() for p in PATHS])
    assert pair.separable
    rng = random.Random(4)
    alphabet = ["a", "b", " ", " ", "  ", "\n", "\t", "\u00a0", "é", "ß", "\u017f", "\u0180", "'", "'s", "'ll", "7", "12", "!", ".", "日", "▁", "𝒳", "\u3000", "\x1f", "\x00", "<s>", "word", "The", "\u200b", "\u0301", "ﬁ"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(3_000)]
    a, b, of_a, of_b = spelt()

    def expected(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        fits = all(b"".join(map(of, i)) == (" " + text).encode() for i, of in zip(ids, (of_a, of_b)))
        return ids if fits else ([], [])

    whole = list(map(expected, texts))
    assert 500 < sum(bool(w[0]) for w in whole) < 3_000
    for remembered, separable in ((100_000, True), (50, True), (0, True), (100_000, False)):
        monkeypatch.setattr(A, "REMEMBERED", remembered)
        pair.separable = separable
        pair.forget()
        got = [both for at in range(0, 3_000, 100) for both in zip(*pair.tokens(texts[at : at + 100]))]
        wrong = [t for t, g, w in zip(texts, got, whole) if (g[0].tolist(), g[1].tolist()) != (list(w[0]), list(w[1]))]
        assert not wrong[:3]


def test_texts_without_common_spelling_have_no_tokens(spark):
    got = dict(zip(TEXTS, aligned(spark, TEXTS)))
    for text in (None, "", "a ▁ piece that stands for a space"):
        assert got[text] == (0, 0, 0, 0, 0, 0, "")
    assert got["<0x41> and <0x0A>"][0] > 0


def test_jumping_reaches_the_last_token_of_a_group():
    # A ends after 2, 4, .., 40 and 41, B after 1, 3, .., 41: one chain of forty-odd tokens.
    ends_a, ends_b = np.array([*range(2, 41, 2), 41]), np.array(range(1, 42, 2))
    assert set(A.terminals(ends_a, ends_b)) == {len(ends_b) - 1}
    assert A.terminals(np.array([3, 5]), np.array([1, 3, 5])).tolist() == [1, 2, 1, 1, 2]
    assert A.terminals(np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_very_long_text(spark):
    text = "The quick brown fox, jumped over 13 lazy dogs. " * 40_000
    (got,) = aligned(spark, [text], 1)
    assert got[0] > 400_000 and got[2] == got[3] > 400_000


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert A.align(frame, *PATHS).collect() == []
    assert aligned(spark, [None]) == [(0, 0, 0, 0, 0, 0, "")]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    found = queries.op12_token_alignment(spark, sf)
    assert found.columns == ["doc_id", *OUT]
    got = sorted(tuple(r) for r in found.collect())
    assert got == [(i, *row) for (i, _), row in zip(rows, brute([t for _, t in rows]))]
