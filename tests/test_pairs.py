"""Answers within a time and groups of two sides, against loops."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.pairs import answers, cogroup

BASE = datetime(2024, 1, 1)
SCHEMA = "user string, topic string, partition int, offset long, timestamp timestamp_ntz, value string"


def side(spark, topic, rows):
    """Rows of (user, offset, seconds, value)."""
    at = lambda s: None if s is None else BASE + timedelta(seconds=s)
    return spark.createDataFrame([(u, topic, 0, o, at(s), v) for u, o, s, v in rows], SCHEMA)


def looped(requests, responses, within, how):
    out = []
    for user, offset, at, _ in requests:
        found = [
            (o, s)
            for u, o, s, _ in responses
            if None not in (user, at, u, s) and u == user and at <= s <= at + within
        ]
        out += [(user, offset, o) for o, _ in found] or ([(user, offset, None)] if how == "left" else [])
    return sorted(out, key=str)


def random_side(rng, n, users=4):
    times = [None if rng.random() < 0.05 else rng.choice([rng.randrange(0, 300), rng.randrange(0, 60) * 10]) for _ in range(n)]
    return [(rng.choice([None, *"abcd"[:users]]), i, t, f"v{i}") for i, t in enumerate(times)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("within", [1, 10, 600])
def test_answers_against_a_loop(spark, how, within):
    rng = random.Random(within)
    requests, responses = random_side(rng, 120), random_side(rng, 150)
    out = answers(side(spark, "q", requests), side(spark, "r", responses), "user", within, how=how, keep=["offset"])
    assert out.columns == ["user", "request_at", "request_offset", "response_at", "response_offset"]
    got = sorted(((r["user"], r["request_offset"], r["response_offset"]) for r in out.collect()), key=str)
    assert got == looped(requests, responses, within, how) and got


def test_both_ends_of_the_interval_belong_to_it(spark):
    out = answers(side(spark, "q", [("a", 1, 100, "")]), side(spark, "r", [("a", n, 100 + d, "") for n, d in enumerate((-1, 0, 60, 61))]), "user", 60)
    assert sorted(r["response_offset"] for r in out.collect()) == [1, 2]


def test_a_busy_key_meets_in_slices(spark):
    busy = side(spark, "q", [("a", n, n, "") for n in range(1_000)])
    out = answers(busy, busy, "user", 5)
    assert out.count() == sum(min(6, 1_000 - n) for n in range(1_000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_answers_refuse_what_they_cannot_do(spark):
    one = side(spark, "q", [("a", 1, 1, "")])
    with pytest.raises(ValueError):
        answers(one, one, "user", 5, how="outer")
    with pytest.raises(ValueError):
        answers(one, one, "user", 0)
    with pytest.raises(TypeError):
        answers(one, one.withColumn("timestamp", F.col("timestamp").cast("timestamp")), "user", 5)
    assert answers(one.limit(0), one, "user", 5, how="left").collect() == []


@pytest.mark.parametrize("segment_rows", [1, 7, 1_000])
def test_cogroup_against_a_loop(spark, segment_rows):
    rng = random.Random(5)
    sides = [random_side(rng, 90), random_side(rng, 60, users=2)]
    sides[0].append(("z", None, 5, "unplaced"))
    expected = defaultdict(lambda: ([], []))
    for number, rows in enumerate(sides):
        for user, offset, _, value in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
            expected[user, -1 if offset is None else offset // segment_rows][number].append(value)
    out = cogroup(side(spark, "a", sides[0]), side(spark, "b", sides[1]), "user", segment_rows=segment_rows).collect()
    got = {(r["user"], r["segment"]): (r["left_values"], r["right_values"]) for r in out}
    assert got == dict(expected) and len(out) == len(got)
    assert all((r["n_left"], r["n_right"]) == (len(r["left_values"]), len(r["right_values"])) for r in out)


def test_cogroup_is_one_pass_and_bounds_a_busy_key(spark):
    busy = side(spark, "a", [("hot", n, n, f"v{n}") for n in range(500)])
    out = cogroup(busy, side(spark, "b", []), "user", segment_rows=50)
    rows = out.collect()
    assert len(rows) == 10 and max(r["n_left"] for r in rows) == 50
    assert [v for r in sorted(rows, key=lambda r: r["segment"]) for v in r["left_values"]] == [f"v{n}" for n in range(500)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_cogroup_keeps_null_values(spark):
    out = cogroup(side(spark, "a", [("k", 1, 1, None), ("k", 2, 1, "x")]), side(spark, "b", [("k", 1, 1, None)]), "user").collect()
    assert [(r["left_values"], r["right_values"]) for r in out] == [([None, "x"], [None])]
