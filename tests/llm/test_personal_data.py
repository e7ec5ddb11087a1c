"""Personal data: base spans against the plain patterns, reliabilities, added spans, redaction."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from millrace.llm import personal_data as P
from millrace.llm import queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def base_of(spark, texts, model=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = model or P.SpanModel({}, {})
    rows = P.find_spans(docs, model, least=2.0).orderBy("doc_id").collect()
    return [[(s["kind"], s["start"], s["end"]) for s in r["pii_spans"]] for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_base_spans_of_random_texts(spark, seed):
    rng = random.Random(seed)
    parts = ["a", "b.c", "@", ".", "..", "-", " ", "1", "12", "255", "256", "+", "+1", "(974)", "555-3436", "4111 1111 1111 1111", "4111111111111111", "é", "", "", "😀", "%", "_", "\n", "x@y.z", "1.2.3.4", "00255.1.1.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(1500)] + [None, "", "1.2.3.4.5.6.7.8.9", "a@b.c_d@e.f", "x@y@z.com"]
    got = base_of(spark, texts)
    for text, spans in zip(texts, got):
        assert spans == brute(text), repr(text)
    assert sum(map(len, got)) > 500


def test_long_runs_take_no_deep_recursion_and_no_square_time(spark):
    texts = ["7" * 200_000, "a" * 200_000 + " @x", "a." * 60_000 + "@" + "b." * 60_000 + "com", "1-" * 100_000 + "1", "+" + "1 " * 50_000, "x_1" * 60_000]
    many = " ".join(f"u{i}@h{i}.org 10.0.{i % 256}.7" for i in range(3_000))
    got = base_of(spark, [*texts, many])
    # Brute force takes square time on the first two, so it judges shorter ones of the same making.
    assert [brute(t) for t in ("7" * 2_000, "a" * 2_000 + " @x")] == [[], []]
    assert got == [[], [], [("email", 0, len(texts[2]))], [], [], []] + [brute(many)]


def test_query_on_whole_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in queries.op9_personal_data(spark, sf).collect()}
    added = 0
    for d in docs:
        spans, row = brute(d["text"]), rows[d["doc_id"]]
        assert [row[f"n_{k}"] for k in P.BASE] == [sum(s[0] == k for s in spans) for k in P.BASE]
        said = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert row["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        listed = [s for s in row["spans"].split(",") if s]
        assert set(said) <= set(listed)
        assert listed == sorted(listed, key=lambda s: (P.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
        added += len(listed) - len(said)
    assert len(rows) == len(docs) and added


def test_secrets_and_addresses_of_any_length_are_candidates(spark):
    key = "aB3_-x9Z" * 1_250
    local, domain = "j" * 300, "h" * 200
    texts = [f"token: {key}", "password=" + "q" * 250 + "1" + "w" * 9_000, f"write {local} [at] {domain} [dot] museumsofmodernartandcrafts"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r["c"] for r in P.with_candidates(docs, "text", "c").orderBy("doc_id").collect()]
    secret, email = P.KINDS.index("secret"), P.KINDS.index("email")
    assert [(c["kind"], c["start"], c["end"]) for c in got[0]] == [(secret, 7, 7 + len(key))]
    assert [(c["kind"], c["start"], c["end"]) for c in got[1]] == [(secret, 9, len(texts[1]))]
    assert (email, 6, len(texts[2])) in [(c["kind"], c["start"], c["end"]) for c in got[2]]
    many = [(n, f"password: {key[n:]}", "x") for n in range(40)] + [(99, "plain words and nothing else", "x")]
    frame = spark.createDataFrame(many, "doc_id long, text string, x string")
    clean = P.redact(P.find_spans(frame, P.fit(frame))).collect()
    assert {r["text"] for r in clean if r["doc_id"] != 99} == {"password: <secret>"}


def test_reliable_labelers_are_told_from_noise():
    rng = random.Random(2)
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.3
        votes = tuple((1 if truth else -1) if rng.random() < right else (-1 if truth else 1) for right in (0.95, 0.9, 0.5, 0.85))
        counts[votes] = counts.get(votes, 0) + 1
    chances, table = P._expectation_maximisation([(0, v, n) for v, n in counts.items()])
    means = [sum(table[0, name]) / 2 for name in P.LABELERS]
    assert means[2] < 0.6 < 0.8 < min(means[0], means[1], means[3])
    assert abs(sum(p * n for p, n in zip(chances, counts.values())) / 20_000 - 0.3) < 0.05


def test_edge_cases_and_redaction(spark):
    rows = [(1, "Mail: jo@ex.org, call +1 (974) 555-3436!", "x"), (1, "Mail: jo@ex.org, call +1 (974) 555-3436!", "x"), (2, None, "y"), (3, "", None), (None, "nothing here", "z")]
    rows += [(4, "password: 0123456789abcdef0123456789abcdef and version 12345678901234567890123", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _candidates string")
    model = P.fit(docs)
    found = P.find_spans(docs, model)
    out = P.redact(found)
    assert sorted((r["doc_id"] or 0, r["text"], r["_candidates"]) for r in out.collect() if r["text"] and r["doc_id"] != 4) == [
        (0, "nothing here", "z"),
        (1, "Mail: <email>, call <phone>!", "x"),
        (1, "Mail: <email>, call <phone>!", "x"),
    ]
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[2] is None and texts[3] == "" and texts[4].startswith("password: <secret> and version 123")
    empty = docs.limit(0)
    assert P.redact(P.find_spans(empty, P.fit(empty))).count() == 0
