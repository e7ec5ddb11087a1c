"""The pipeline's stages, each against a brute-force version on its own input."""

from __future__ import annotations

import re

import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from millrace.llm import bpe_queue
from test_decontaminate import brute as brute_overlaps
from test_near_copies import brute_classes
from test_personal_data import brute as brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe_queue.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_stages_on_the_sample(spark, tmp_path, encoding):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [{r["doc_id"]: r for r in docs.collect()}]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert docs.columns == columns or n == 4
        tables.append({r["doc_id"]: r for r in docs.collect()})
    start, told, firsts, clean, redacted, coded = tables
    assert all(told[i] == start[i] for i in told)
    assert len(told) >= 0.98 * len(start) and all(re.search(r"[^\W\d_]", told[i]["text"]) for i in told)
    classes = brute_classes([(i, r["text"]) for i, r in sorted(told.items())])
    assert firsts == {i: told[i] for i, c in classes.items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    judged = brute_overlaps([r["text"] for r in firsts.values()], items, 13)
    assert clean == {i: r for (i, r), (_, _, _, bad) in zip(firsts.items(), judged) if not bad}
    assert redacted.keys() == clean.keys() == coded.keys()
    for i, r in redacted.items():
        spans = sorted((a, b, k) for k, a, b in brute_spans(clean[i]["text"]))
        for (a, b, kind), (c, _, _) in zip(spans, [*spans[1:], (len(clean[i]["text"]), 0, "")]):
            assert clean[i]["text"][a:b] not in r["text"] and f"<{kind}>" in r["text"]
        assert r["n_chars"] == len(r["text"])
        assert list(coded[i]["token_ids"]) == encoding.encode_ordinary(r["text"])
        assert bytes(coded[i]["decoded"]).decode() == coded[i]["text"] == r["text"]


def test_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, contaminated int, token_ids string, _class int"
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "?!", "en", "s", 2), (4, "some plain words here", "en", "s", 21), (4, "some plain words here", "en", "s", 21)]
    rows += [(None, "some plain words here", None, None, None), (5, long, "en", None, 1), (6, "mail me: a@b.org or wait for the letter", "en", "s", 38), (7, "ñandú años también", "es", "s", 17)]
    docs = spark.createDataFrame([(*r, 1, "t", None) for r in rows], schema)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        kept.append(sorted(r["doc_id"] or 0 for r in docs.collect()))
    assert kept == [[0, 4, 4, 5, 6, 7], [0, 4, 5, 6, 7], [0, 4, 5, 6, 7], [0, 4, 5, 6, 7]]
    out = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert out[6]["text"] == "mail me: <email> or wait for the letter" and out[6]["n_chars"] == 39
    assert out[None]["n_chars"] is None and out[5]["contaminated"] == 1 and len(out[5]["token_ids"]) > 20_000


def test_empty_documents_pass_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
