"""BPE against the reference library, round trips, edge cases."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import tiktoken

from millrace.llm import bpe_queue as B
from millrace.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = B.read_ranks(PATH)
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_random_texts_and_long_pieces():
    codec, rng = B.Codec(RANKS, public_tokenizers.PATTERN), random.Random(1)
    letters = "ab \n\t\x1c\x1d\x85 ᠎​é漢字1²Ⅷ'sTll!?\U0001f600\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3_000)]
    texts += ["a" * 3_000 + "漢" * 500, "xyz" * 900, "<|endoftext|>", "".join(rng.choice("etaoin") for _ in range(4_000))]
    for text in texts:
        ids = codec.encode(text)
        assert ids == ENCODING.encode_ordinary(text)
        assert codec.decode(ids).decode() == text


def test_a_piece_of_a_million_bytes():
    codec = B.Codec(RANKS, public_tokenizers.PATTERN)
    text = "abcab" * 200_000
    ids = codec.encode(text)
    assert codec.decode(ids).decode() == text and len(ids) < len(text) / 2


def test_small_vocabulary_is_merged_by_rank_then_place():
    ranks = {bytes([b]): b for b in b"abc"} | {b"ab": 300, b"aa": 200, b"aab": 400, b"bc": 250}
    encode = B.piece_encoder(ranks)
    assert encode(b"aaab") == (200, 300)
    assert encode(b"abc") == (97, 250)
    assert encode(b"aab") == (400,)


def test_query_on_whole_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = ENCODING.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_edge_cases(spark):
    rows = [(1, None, "p"), (2, "", "p"), (3, "hello", "p"), (3, "hello", "p"), (None, "a" * 300_000, None)]
    out = B.encode(spark.createDataFrame(rows, "doc_id long, text string, _pair string"), PATH, public_tokenizers.PATTERN)
    got = [(r["doc_id"], list(r["token_ids"]), bytes(r["decoded"]).decode(), r["_pair"]) for r in out.collect()]
    assert got[:4] == [(1, [], "", "p"), (2, [], "", "p"), (3, [31373], "hello", "p"), (3, [31373], "hello", "p")]
    assert got[4][2] == "a" * 300_000
    assert B.encode(out.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_a_batch_of_texts_is_not_made_whole():
    batch = pa.array(["x" * 1_000] * 20_000)
    tracemalloc.start()
    rows = sum(len(run) for run in B.portions(batch, chars=100_000))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 20_000 and most < 1_000_000  # all at once: 20 MB
