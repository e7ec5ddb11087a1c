"""Filter orders against applying the filters one after the other."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from millrace.llm import filter_audit as A
from millrace.llm import queries

DOCS = "doc_id long, text string, lang string, id string, code int, n string"
LABELS = "doc_id long, quality int, toxic int"


def fails(rows):
    """The filters that each row fails, as a set of letters."""
    ids = {}
    for i, text, _ in rows:
        if i is not None:
            ids.setdefault(text or "", []).append(i)
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 100:
            failed.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            failed.add("C")
        if re.search(r"[#$%&*|]", text):
            failed.add("D")
        if i is not None and min(ids[text]) < i:
            failed.add("E")
        out.append(failed)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    judged = [(i, lang or "", f) for (i, _, lang), f in zip(rows, fails(rows))]
    out = {}
    for part in {p for _, p, _ in judged}:
        here = [(i, f) for i, p, f in judged if p == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = here
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                total[letter] += len(gone)
                failing = sum(letter in f for _, f in here)
                alone = sum(f == {letter} for _, f in here)
                lost = [sum(i in marked for i, _ in gone) for marked in (good, toxic)]
                out[part, order, step] = [len(left), len(gone), failing - len(gone), alone, *lost]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 9, "y") for r in rows], DOCS)
    out = A.interactions(docs, spark.createDataFrame(labels, LABELS)).collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in out}
    assert len(got) == len(out)
    return got


def agree(got, expected):
    """Equal; told by the first few cells that differ, as a full comparison of thousands takes minutes."""
    wrong = [(k, got.get(k), expected.get(k)) for k in sorted(got.keys() | expected.keys()) if got.get(k) != expected.get(k)]
    assert not wrong[:3]


def words(n, first=0):
    return " ".join(f"word{k}" for k in range(first, first + n))


ROWS = [
    (1, words(120), "en"),
    (2, words(120), "en"),
    (3, words(120), "de"),
    (4, words(99), "en"),
    (5, words(100) + " $", "en"),
    (6, words(70) + " " + words(70), "en"),
    (7, words(50) + " " + "SHOUT " * 60, "en"),
    (8, "", "de"),
    (9, None, "de"),
    (10, None, None),
    (11, "A| B", ""),
    (12, words(200).upper() + " #", None),
    (None, words(120), "en"),
    (None, "", "en"),
    (3, words(120), "de"),
    (1, words(120), "en"),
    (13, "  \x0b\x0c é " + words(101, 7), "en"),
    (14, words(40_000), "fr"),
    (0, "A| B", "fr"),
]


def test_orders_against_one_after_the_other(spark):
    labels = [(1, 1, 0), (2, 1, 1), (4, 0, 1), (5, None, 1), (7, 1, None), (7, 1, 1), (99, 1, 1), (None, 1, 1), (9, 1, 0), (3, 1, 1)]
    agree(found(spark, ROWS, labels), brute(ROWS, labels))


def test_many_copies_and_repeated_ids(spark):
    rows = [(n % 90, words(100 + n % 3) + "|" * (n % 2), "en" if n % 4 else "de") for n in range(240)]
    agree(found(spark, rows, [(5, 1, 1)]), brute(rows, [(5, 1, 1)]))


def test_empty_tables(spark):
    assert found(spark, [], []) == {}
    agree(found(spark, [(1, None, None)], []), brute([(1, None, None)], []))


def test_counts_are_combined_before_they_are_shuffled(spark):
    docs = spark.createDataFrame([(n, "same", "en", "x", 1, "y") for n in range(500)], DOCS).repartition(4)
    labels = spark.createDataFrame([], LABELS)
    plan = A.outcomes(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "CartesianProduct" not in plan and "Python" not in plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_and_twin(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = sorted(map(tuple, queries.op11_filter_audit(spark, folder).collect()))
    with duckdb.connect() as duck:
        for name in ("documents", "labels"):
            duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        result = duck.execute(queries.SQL["op11_filter_audit"])
        names = [c[0] for c in result.description]
        expected = sorted(result.fetchall())
    assert names == queries.op11_filter_audit(spark, folder).columns
    agree({r[:3]: r[3:] for r in got}, {r[:3]: r[3:] for r in expected})
    assert len(got) == len(expected) and len(got) % 600 == 0
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    agree({r[:3]: r[3:] for r in got}, brute(rows, labels))
