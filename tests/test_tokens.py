"""Tokens against a model of splitting at single spaces."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators.tokens import token_counts


def model(text):
    if text == "":
        return [""]
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_cases(spark):
    cases = {"a b a": ["a", "b", "a"], "a  b  ": ["a", "", "b"], " a": ["", "a"], "": [""], "   ": []}
    df = spark.createDataFrame([(k,) for k in cases], "value string")
    for r in df.select("value", tokens(F.col("value")).alias("t")).collect():
        assert r["t"] == cases[r["value"]] == model(r["value"])


def test_other_white_space_is_part_of_a_token(spark):
    df = spark.createDataFrame([("a\tb\n",)], "value string")
    assert [r["value"] for r in token_counts(df).collect()] == ["a\tb\n"]


def test_null_adds_nothing(spark):
    df = spark.createDataFrame([(None,), ("x",)], "value string")
    assert [tuple(r) for r in token_counts(df).collect()] == [("x", 1)]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab é\t", max_size=8), min_size=1, max_size=50))
def test_counts_against_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r["value"]: r["count"] for r in token_counts(df).collect()}
    assert got == Counter(token for text in texts for token in model(text))
