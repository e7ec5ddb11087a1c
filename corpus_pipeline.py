"""From raw documents to token ids: the stages of a training-data pipeline, each a written table.

====================  =================================================================================
language ID           documents whose language cannot be told go; the network is trained on the input's
                      own labels
near copies           one document of each class of near copies stays, the one with the smallest id
decontamination       documents of which a twentieth or more are benchmark windows go
personal data         spans are replaced by their kinds, and ``n_chars`` follows
byte-level BPE        token ids and the bytes they decode to come beside each document
====================  =================================================================================

Rows of one id count as one document from the second stage on; rows without an id stay. Null texts are
rejected by the first stage. Columns beyond those of documents pass through all stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe_queue, decontaminate, language_id, near_copies, personal_data
from millrace.llm.common import fresh, shared_folder, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language the network can tell."""
    return language_id.accept(docs, language_id.train(docs))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_copies.first_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated; their texts are unchanged."""
    helpers = ("n_words", "hit_spans", "n_hit", "hit_items", "contaminated")
    clash = {c: n for c, n in zip(helpers, fresh(docs, *helpers)) if c in docs.columns}
    named = docs.withColumnsRenamed(clash)
    clean = decontaminate.find_overlaps(named, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).drop(*helpers)
    return clean.withColumnsRenamed({n: c for c, n in clash.items()}).select(docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    (spans,) = fresh(docs, "spans")
    found = personal_data.find_spans(docs, personal_data.fit(docs), spans=spans)
    clean = personal_data.redact(found, spans=spans)
    touched = F.size(spans) > 0
    return clean.withColumn("n_chars", F.when(touched, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and the bytes these decode to."""
    return bpe_queue.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_stage),
    ("near copies", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("personal data", personal_data_stage),
    ("byte-level BPE", encode_stage),
]

#: No SQL can express the trained stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
