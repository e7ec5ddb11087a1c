"""Repeated passages: planted ones, chains against all chains, the sample against every 50-word window."""

from __future__ import annotations

import random
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash

from millrace.llm import queries
from millrace.llm import repeated_passages as R
from millrace.llm.decontaminate import words_of


def test_best_chain_against_all_chains():
    rng = random.Random(6)
    for _ in range(200):
        matches = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randint(1, 8))})
        best = 0.0
        for size in range(1, len(matches) + 1):
            for chain in combinations(matches, size):
                if all(p[0] < q[0] and p[1] < q[1] for p, q in zip(chain, chain[1:])):
                    cost = sum(R.GAP_COST * (q[0] - p[0] + q[1] - p[1]) for p, q in zip(chain, chain[1:]))
                    best = max(best, R.SEED * size - cost)
        got = R.chains(matches)[0]
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        cost = sum(R.GAP_COST * (q[0] - p[0] + q[1] - p[1]) for p, q in zip(got, got[1:]))
        assert abs(R.SEED * len(got) - cost - best) < 1e-9


def test_equal_runs_share_a_seed():
    rng = np.random.default_rng(2)
    for _ in range(100):
        run = rng.integers(0, 1 << 63, R.SEED + R.SPREAD - 1, dtype=np.uint64)
        texts = [np.concatenate([rng.integers(0, 1 << 63, rng.integers(0, 30), dtype=np.uint64), run, rng.integers(0, 1 << 63, 20, dtype=np.uint64)]) for _ in range(2)]
        a, b = (set(R.seeds_of(t)[0].tolist()) for t in texts)
        assert a & b


def _word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(6))


def test_planted_passages(spark):
    rng = random.Random(9)
    say = lambda n: [_word(rng) for _ in range(n)]
    exact, fuzzy, short = say(55), say(120), say(30)
    docs, planted = [], {}

    def plant(name, passage, count, filler):
        for _ in range(count):
            i = len(docs)
            docs.append((i, " ".join(say(rng.randrange(filler)) + passage() + say(rng.randrange(filler)))))
            planted.setdefault(name, set()).add(i)

    def edited():
        w = list(fuzzy)
        for at in rng.sample(range(len(w)), 6):
            w[at : at + 1] = rng.choice([[], [_word(rng)], [w[at], _word(rng)]])
        return w

    plant("exact", lambda: exact, 40, 300)
    plant("fuzzy", edited, 25, 200)
    plant("short", lambda: short, 60, 200)
    plant("clean", lambda: [], 40, 400)
    half, other = say(30), say(30)  # each half has a shorter document of its own, only two have both
    docs += [(900, " ".join(half)), (901, " ".join(other)), (902, " ".join(say(90) + half + other + say(50))), (903, " ".join(say(120) + half + other + say(90)))]
    docs += [(990, None), (991, ""), (None, " ".join(exact)), (0, docs[0][1])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, a int")
    found = R.repeated(frame).collect()
    inside = {r["a"] for r in found} | {r["b"] for r in found}
    assert inside == planted["exact"] | planted["fuzzy"] | {902, 903}
    texts = {i: words_of(t) for i, t in docs if i is not None and t}
    for r in found:
        x, y = texts[r["a"]][r["a_start"] : r["a_end"]], texts[r["b"]][r["b_start"] : r["b_end"]]
        assert len(texts[r["a"]]) <= len(texts[r["b"]]) and r["equal"] >= R.PASSAGE
        if r["a"] in planted["exact"]:
            assert x == y and len(x) >= 55
    left = {r["doc_id"]: r["text"] for r in R.without_repeats(frame, R.repeated(frame)).where("doc_id is not null").collect()}
    assert left[990] is None and left[991] == ""
    assert sum(" ".join(exact) in (t or "") for t in left.values()) == 1
    assert all(left[i] == docs[i][1] for i in planted["clean"] | planted["short"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert R.repeated(empty).count() == 0 and R.without_repeats(empty, R.repeated(empty)).count() == 0


def test_query_finds_every_document_with_a_repeated_window(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: words_of(r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    owner, expected = {}, set()
    for i, words in docs.items():
        for at in range(len(words) - R.PASSAGE + 1):
            window = tuple(words[at : at + R.PASSAGE])
            if owner.setdefault(window, i) != i:
                expected |= {i, owner[window]}
    rows = queries.op8_repeated_passages(spark, sf).collect()
    got = {r["doc_id"] for r in rows}
    assert expected <= got and expected
    for r in rows:
        x, y = docs[r["doc_id"]][r["start_word"] : r["end_word"]], docs[r["twin_id"]][r["twin_start_word"] : r["twin_end_word"]]
        row = [0] * (len(y) + 1)
        for w in x:
            new = [0]
            for j, v in enumerate(y):
                new.append(row[j] + 1 if v == w else max(row[j + 1], new[j]))
            row = new
        assert row[-1] >= r["n_equal"] >= 50 and r["n_equal"] >= 0.8 * max(len(x), len(y))


def test_two_passages_in_the_same_order(spark):
    rng = random.Random(21)
    say = lambda n: [_word(rng) for _ in range(n)]
    docs, parts = [], {}
    for n, (size, gap, other) in enumerate([(60, 50, 50), (60, 100, 100), (60, 200, 200), (100, 150, 150), (60, 50, 57), (60, 110, 90)]):
        first, last = say(size), say(size)
        parts[2 * n] = (" ".join(first), " ".join(last))
        docs += [(2 * n, " ".join(say(10) + first + say(gap) + last + say(10))), (2 * n + 1, " ".join(say(20) + first + say(other) + last + say(20)))]
    found = R.repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = {i: words_of(t) for i, t in docs}
    for i, both in parts.items():
        spans = [b" ".join(texts[i][r["a_start"] : r["a_end"]]).decode() for r in found if r["a"] == i and r["b"] == i + 1]
        assert len(spans) == 2 and all(any(p in s for s in spans) for p in both)
    assert len(found) == 2 * len(parts)


def test_passage_of_frequent_lines(spark):
    rng = random.Random(33)
    say = lambda n: [_word(rng) for _ in range(n)]
    first, last = say(30), say(30)
    docs = []
    for n in range(6):  # short documents with one of the lines, some of them copies, and longer ones
        docs += [first, last, say(2) + first + say(25 + n), say(3) + last + say(26 + n)]
    docs += [say(40) + first + last + say(50), say(70) + first + last + say(60), say(90) + first + last + say(80)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    found = {(r["a"], r["a_start"], r["a_end"], r["b"], r["b_start"], r["b_end"], r["equal"]) for r in R.repeated(frame).collect()}
    assert found == {(24, 40, 100, 25, 70, 130, 60), (24, 40, 100, 26, 90, 150, 60)}


def test_short_chain_in_a_passage_with_shifts():
    rng = np.random.default_rng(12)
    say = lambda n: rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    words = say(66)
    pieces = np.split(words, [10, 20, 30, 40, 52])
    moved = np.concatenate([np.concatenate([p, say(1)]) for p in pieces])  # a word put in after each piece
    x, y = np.concatenate([say(20), words, say(20)]), np.concatenate([say(30), moved, say(30)])
    assert [p[4] for p in R.passages(x, y, [(20 + 41, 30 + 45)])] == [66]


def test_texts_are_read_once_for_seeds(spark, monkeypatch):
    rng = random.Random(8)
    line = [_word(rng) for _ in range(60)]
    docs = [(n, " ".join([_word(rng) for _ in range(10)] + line)) for n in range(20)]
    read, whole = spark.sparkContext.accumulator(0), R._seeded

    def counted(batches):
        def seen():
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        yield from whole(seen())

    monkeypatch.setattr(R, "_seeded", counted)
    found = R.repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["b"] for r in found} == set(range(1, 20))
    assert read.value == 20


def test_words_in_common_of_long_gaps():
    rng = np.random.default_rng(3)
    for size, other, words in ((40, 25, 3), (200, 201, 20), (1, 9, 2), (0, 4, 2)):
        x, y = rng.integers(0, words, size, dtype=np.uint32), rng.integers(0, words, other, dtype=np.uint32)
        table = np.zeros((size + 1, other + 1), int)
        for i in range(size):
            for j in range(other):
                table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
        assert R._equal_between(x, y) == table[-1, -1]
    x, y = (rng.integers(0, 1000, n, dtype=np.uint32) for n in (20_000, 20_001))
    before = time.process_time()
    assert R._equal_between(x, y) > 500
    assert time.process_time() - before < 1  # a row of the table as an array each: 3 seconds


def test_going_on_after_differences():
    say = lambda text: np.array([ord(c) for c in text], np.uint32)
    assert R._prolong(say("abcdefgh"), say("abcdxfgh")) == (8, 8, 7)
    assert R._prolong(say("abcdefgh"), say("abcdfgh")) == (8, 7, 7)
    assert R._prolong(say("abcdefghij"), say("abcdexyfghij")) == (10, 12, 10)
    assert R._prolong(say("abcdefg"), say("abcdxfg")) == (4, 4, 4)  # only two words agree again
    assert R._prolong(say("abc"), say("xyz")) == (0, 0, 0)


def test_hashes_of_words_in_a_row():
    numbers = np.random.default_rng(5).integers(0, 1 << 63, 70, dtype=np.uint64)
    for size in (1, 3, R.SEED, R.PASSAGE, 70):
        total = np.zeros(70 - size + 1, np.uint64)
        for k in range(size):
            total = total * R._FACTOR + numbers[k : k + len(total)]
        assert np.array_equal(R._rolled(numbers, size), total)


def test_passage_whose_seeds_are_led_by_many_shorter_documents(spark):
    rng = random.Random(17)
    say = lambda n: [_word(rng) for _ in range(n)]
    passage = say(72)
    changed = [w if n % 24 != 23 else _word(rng) for n, w in enumerate(passage)]
    docs = [say(60) + passage + say(60), say(80) + changed + say(80)]
    for n in range(6):  # each has one third of it, and is shorter than both
        docs += [say(2 + n) + docs[0][60 + at - 13 : 60 + at + 36] + say(2) for at in (0, 24, 48)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    found = {tuple(r) for r in R.repeated(frame).select("a", "a_start", "a_end", "b", "b_start", "b_end", "equal").collect()}
    assert found == {(0, 60, 131, 1, 80, 151, 69)}


def test_no_pair_with_enough_words_in_common_is_missed(monkeypatch):
    rng = np.random.default_rng(14)
    texts = [rng.integers(0, words, rng.integers(0, 200), dtype=np.uint32) for words in (1, 3, 60, 300, 1 << 31) for _ in range(12)]
    texts += [np.where(rng.random(150) < 0.3, rng.integers(0, 1 << 31, 150), 7 * np.arange(150)).astype(np.uint32) for _ in range(12)]
    expected = {(i, j) for i, x in enumerate(texts) for j, y in enumerate(texts) if R._longest_common(x, y) >= R.PASSAGE}
    for bits in (R.BITS, 128):
        monkeypatch.setattr(R, "BITS", bits)
        assert expected <= set(R._agreeing(texts, texts)) and len(expected) > 100


def test_a_word_said_over_and_over_is_told_without_all_pairs(spark):
    rng = random.Random(26)
    say = lambda n: [_word(rng) for _ in range(n)]
    docs = [say(rng.randrange(5, 30)) + ["over"] * (60 + 13 * n) + say(rng.randrange(5, 30)) for n in range(40)]
    found = R.repeated(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")).collect()
    for i, words in enumerate(docs):
        told = [range(r[f"{k}_start"], r[f"{k}_end"]) for r in found for k in "ab" if r[k] == i]
        left = {n for n, w in enumerate(words) if w == "over"} - {n for span in told for n in span}
        assert len(left) < R.SPREAD  # seeds of one word said on lie so far apart
    assert len({(r["a"], r["b"]) for r in found}) < 5 * len(docs)  # there are 780 pairs


def test_equal_words_in_passages_that_adjoin_are_told():
    x, y = np.full(60, 7, np.uint32), np.full(200, 7, np.uint32)
    found = R.passages(x, y, [(0, n) for n in range(151)])
    assert all(e - s == f - t == n >= R.PASSAGE for s, e, t, f, n in found)
    assert all(any(t <= at and at + R.SEED <= f for _, _, t, f, _ in found) for at in range(200 - R.SEED + 1))
    assert len(found) < 9


def test_an_open_occurrence_is_told_with_one_document():
    rng = np.random.default_rng(31)
    say = lambda n: rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    text, seed, rows = say(2 * R.AROUND + R.SEED), R.AROUND, []
    for n in range(40):  # near copies of one text, and five others with its seed alone
        words = np.where(rng.random(len(text)) < 0.06, say(len(text)), text) if n < 35 else say(len(text))
        words[seed : seed + R.SEED] = text[seed : seed + R.SEED]
        for left in (True, False):
            rows.append({"seed": 5, "i": 0, "j": 0, "left": left, "id": n, "size": 400 - n, "first": 100, "last": 100, "open": True, "around": words.tobytes()})
    met = [row for batch in R._meeting(iter([pa.RecordBatch.from_pylist(rows)])) for row in batch.to_pylist()]
    assert [row["own"] for row in met] == sorted(range(35), reverse=True)  # all pairs would be 595
    for row in met:
        (start, end), (to, until) = row["at_own"], row["at_beside"]
        assert row["equal"] >= R.PASSAGE and row["equal"] >= R.IDENTITY * max(end - start, until - to)
        assert start <= 100 and 100 + R.SEED <= end and row["own"] != row["beside"]
    assert {row["beside"] for row in met} <= {34, 33, 32, 31}  # the shortest that has a passage with it


def test_words_in_a_row_meet_those_next_to_the_diagonal():
    rng = np.random.default_rng(32)
    for off in (-9, 0, 14):
        x, y = (rng.integers(0, 2, n, dtype=np.uint32) for n in (120, 150))
        pairs = {}
        for i in range(len(x) - R.SEED + 1):
            equal = [j for j in range(len(y) - R.SEED + 1) if (x[i : i + R.SEED] == y[j : j + R.SEED]).all()]
            if equal:
                pairs[i] = min(abs(j - max(0, i + off)) for j in equal)
        got = R._alike(R._grams(x), np.sort(R._grams(y)), off)
        assert all((x[i : i + R.SEED] == y[j : j + R.SEED]).all() and abs(j - max(0, i + off)) == pairs[i] for i, j in got)
        between = {i for (i, j), (p, q) in zip(got, got[1:]) if p - i == q - j for i in range(i, p)}
        assert set(pairs) <= between | {i for i, _ in got}


def test_parts_of_passages_are_told_whole():
    rng = np.random.default_rng(33)
    say = lambda n: rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    line = say(300)
    x, y = np.concatenate([say(20), line, say(30)]), np.concatenate([say(50), line, say(10)])
    parts = [(80, 150, 110, 180, 70), (200, 260, 230, 290, 60)]
    assert R._whole_parts(x, y, parts) == [(20, 320, 50, 350, 300)]
    assert R._whole_parts(say(400), y, parts) == []  # rows of one id with different texts


def test_near_copies_with_open_seeds_are_not_told_in_pairs(spark):
    rng = random.Random(34)
    say = lambda n: [_word(rng) for _ in range(n)]
    text = say(150)
    docs = [[w if rng.random() > 0.1 else _word(rng) for w in text] + say(n % 7) for n in range(60)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    found = {(r["a"], r["b"]) for r in R.repeated(frame).collect()}
    assert {i for pair in found for i in pair} == set(range(60)) and len(found) < 5 * len(docs)  # there are 1,770 pairs


def test_a_text_is_hashed_for_its_words_once(spark, monkeypatch):
    rng = random.Random(17)
    say = lambda n: [_word(rng) for _ in range(n)]
    passage = say(72)
    changed = [w if n % 24 != 23 else _word(rng) for n, w in enumerate(passage)]
    docs = [say(60) + passage + say(60), say(80) + changed + say(80)]
    for n in range(6):  # they lead the seeds of both in all rounds, which meet in the last step alone
        docs += [say(2 + n) + docs[0][60 + at - 13 : 60 + at + 36] + say(2) for at in (0, 24, 48)]
    numbered, whole = spark.sparkContext.accumulator(0), R._numbered

    def counted(batches):
        def seen():
            for batch in batches:
                numbered.add(batch.num_rows)
                yield batch

        yield from whole(seen())

    monkeypatch.setattr(R, "_numbered", counted)
    found = {(r["a"], r["b"]) for r in R.repeated(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")).collect()}
    assert found == {(0, 1)}
    assert 0 < numbered.value <= len(docs)


def test_words_are_hashed_as_by_xxhash():
    rng = random.Random(35)
    letters = ["a", "Z", "7", "é", "日", "-", "\n"]
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(45))) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += [None, "", " ", *("w" * n for n in range(70)), "x" * 3_000, "long " * 150_000, ""]
    numbers = [part for found, many in R.numbers_of(texts) for part in np.split(found, np.cumsum(many)[:-1])]
    assert [part.tolist() for part in numbers] == [[xxhash.xxh64_intdigest(w) for w in words_of(t or "")] for t in texts]


def test_seeds_of_texts_together_are_those_of_each():
    rng = np.random.default_rng(36)
    texts = [rng.integers(0, words, rng.integers(R.PASSAGE, 200), dtype=np.uint64) for words in (1, 2, 1 << 63) for _ in range(20)]
    texts += [np.concatenate([t, np.full(100, 5, np.uint64), t]) for t in texts[-3:]]
    seeds, text, places = R._seeds_of_all(np.concatenate(texts), np.array([len(t) for t in texts]))
    for n, numbers in enumerate(texts):
        expected = R.seeds_of(numbers)
        assert set(zip(seeds[text == n].tolist(), places[text == n].tolist())) == set(zip(*(c.tolist() for c in expected)))
        assert (text == n).sum() == len(expected[0])


def test_few_bits_keep_pairs_that_all_bits_keep():
    rng = np.random.default_rng(37)
    line = rng.integers(0, 1 << 31, 90, dtype=np.uint32)
    for near in (3, 150, 600):  # so many near copies among 600: few pairs, many in some blocks, all
        texts = [np.where(rng.random(90) < (0.2 if n < near else 0.95), rng.integers(0, 1 << 31, 90, dtype=np.uint32), line) for n in range(600)]
        texts[::7] = [np.concatenate([t, t[:60]]) for t in texts[::7]]
        bits, lost = R._bits(texts)
        common = np.array([np.bitwise_count(row & bits).sum(axis=1) for row in bits]) + np.minimum(lost[:, None], lost)
        assert set(R._agreeing(texts, texts)) == set(map(tuple, np.argwhere(common >= R.PASSAGE).tolist()))
