"""Language identification: held-out accuracy, gradients, edge cases."""

from __future__ import annotations

import zlib

import numpy as np

from millrace.llm import language_id as L
from millrace.llm import queries

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    model = L.ByteCnn.untrained(["a", "b", "c"], 3)
    for k, w in enumerate(weights := model.weights()):
        weights[k] = w
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 257, (5, L.WINDOW)).astype(np.int16)
    answers = np.array([0, 1, 2, 1, 0])
    loss = lambda: -np.log(L.softmax(model.logits(windows).astype(np.float64))[np.arange(5), answers]).mean()
    for w, g in zip(model.weights(), model.gradients(windows, answers)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, eps = w[at], 2e-3
        w[at] = kept + eps
        up = loss()
        w[at] = kept - eps
        down = loss()
        w[at] = kept
        assert abs((up - down) / (2 * eps) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_windows_cover_every_run_of_bytes():
    for size in (0, 1, 3, 255, 256, 257, 508, 509, 510, 5000):
        data = bytes(np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8))
        seen = {w[i : i + 4].tobytes() for w in L.windows_of(data) for i in range(L.WINDOW - 3)}
        assert all(np.frombuffer(data[i : i + 4], np.uint8).astype(np.int16).tobytes() in seen for i in range(size - 3))


def test_query_on_the_held_out_fold(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op4_language_id(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(tested) > 0.98


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string, _answer int"
    rows = [(1, None, "xx", "s", 1), (2, "", "xx", "s", 1), (3, "12 ?!", "xx", "s", 1), (4, "hello there my friend", "xx", "s", 1)]
    rows += [(5, "hello there my friend", None, "s", 1), (None, "ñandú y ñu " * 20_000, "yy", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    model = L.train(docs)
    assert model.languages == ["xx", "yy"]
    got = L.predict(docs, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["yy", "und", "und", "und", "xx", "xx"]
    assert [r["score"] for r in got[1:4]] == [0, 0, 0] and got[4]["score"] == got[5]["score"] and got[0]["_answer"] == 1
    assert L.train(docs.limit(0)) is None
    assert {r["lang_pred"] for r in L.predict(docs, None).collect()} == {"und"}
    assert L.predict(docs.limit(0), model).count() == 0
    assert sorted(r["doc_id"] or 0 for r in L.accept(docs, model).collect()) == [0, 4, 5]


def test_quotas():
    assert L.quotas({"a": 5_000, "b": 5_000, "c": 60}, 6_000) == {"a": 2_970, "b": 2_970, "c": 60}
    assert L.quotas({"a": 10, "b": 20}, 6_000) == {"a": 10, "b": 20}
    assert set(L.quotas({str(n): 9 for n in range(50)}, 10).values()) == {1}


def test_rare_languages_keep_all_their_rows_in_the_sample(spark):
    rows = [(f"text {k} of language {n}", f"l{n}") for n in range(8) for k in range(2_500)] + [(f"rare words {k}", "rare") for k in range(60)]
    texts, languages = L.sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    counts = {name: languages.count(name) for name in set(languages)}
    assert counts["rare"] == 60 and 5_500 < len(texts) <= 7_200
    assert min(counts[f"l{n}"] for n in range(8)) > 600


def test_more_languages_than_a_sample_has_rows(spark):
    rows = [(f"word{n} and word{n}", f"l{n}") for n in range(1_200)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = L.train(docs, size=600)
    assert len(model.languages) == 1_200
    assert L.predict(docs.limit(20), model).count() == 20
