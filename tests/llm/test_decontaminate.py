"""Decontamination against a search for every window in every document."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from millrace.llm import decontaminate as D
from millrace.llm import queries

WORD = re.compile(D.WORD)


def fold(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    """doc rows to (n_words, n_hit, items, contaminated) by comparing every place with every window."""
    windows = {}
    for name, text in items:
        words = fold(text)
        if words:
            for i in range(max(1, len(words) - window + 1)):
                windows.setdefault(tuple(words[i : i + window]), set()).add(None if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        words, hit, names = fold(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((len(words), len(hit), sorted(names - {None}), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def found(spark, docs, items, **how):
    left = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, _overlap string")
    right = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_overlaps(left, right, **how).orderBy("doc_id").collect()
    assert all(r["_overlap"] == "x" for r in rows)
    return [(r["n_words"], r["n_hit"], list(r["hit_items"]), r["contaminated"]) for r in rows]


@pytest.mark.parametrize("block_words", [40, 200_000])
def test_small_alphabet_against_brute_force(spark, block_words):
    rng = random.Random(block_words)
    say = lambda n, k: " ".join(rng.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i, say(rng.randint(0, 9), 4)) for i in range(30)] + [(99, None), (None, "a b c d"), (3, "a a a a a")]
    docs = [say(rng.randint(0, 60), rng.choice([3, 5, 8])) for _ in range(60)] + [None, "", "a b", "?!"]
    assert found(spark, docs, items, window=5, block_words=block_words) == brute(docs, items, 5)


def test_item_longer_than_a_block_and_long_text(spark):
    rng = random.Random(5)
    item = " ".join(f"w{rng.randint(0, 300)}" for _ in range(500))
    words = item.split()
    docs = [" ".join(words[i : i + 14]) for i in range(0, 486, 7)] + [" ".join(["x"] * 40_000 + words[100:160] + ["É"] * 40_000)]
    assert found(spark, docs, [(1, item)], block_words=120) == brute(docs, [(1, item)], 13)


def test_empty_tables_and_removal(spark):
    assert found(spark, ["a b"], []) == [(2, 0, [], False)]
    assert found(spark, [], [(1, "a b")]) == []
    docs = spark.createDataFrame([(1, "Keep, this. Secret item-text here! And " + "more " * 100), (2, "secret item text"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "secret item text")], "item_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in D.remove_overlaps(D.find_overlaps(docs, items)).collect()}
    assert rows == {1: "Keep, this.  here! And " + "more " * 100, 3: None}


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    expected = {
        d["doc_id"]: (w, h, len(n), hashlib.sha256(",".join(n).encode()).hexdigest(), c)
        for d, (w, h, n, c) in zip(docs, brute([d["text"] for d in docs], items, 13))
    }
    assert any(e[4] for e in expected.values())
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op3_decontaminate(spark, sf_dir).collect()} == expected
