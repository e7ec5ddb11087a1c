"""Offset ranges, their text, the ledger and resuming."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators.offsets import (
    decode_offsets,
    encode_offsets,
    latest_offsets,
    merge_ranges,
    offset_gaps,
    offset_islands,
    offset_ranges,
    resume_from,
    safe_offsets,
)
from millrace.sources.offsets import read_ledger, starting_offsets, write_ledger

POINTS = "topic string, partition int, offset bigint"


def test_ranges(make_messages):
    rows = [("A", 0, o, 0, "x") for o in (5, 9, 7)] + [("A", 1, 0, 0, "x"), ("B", 0, 3, 0, "x")]
    out = {(r["topic"], r["partition"]): tuple(r)[2:] for r in offset_ranges(make_messages(rows)).collect()}
    assert out == {("A", 0): (5, 10, 3), ("A", 1): (0, 1, 1), ("B", 0): (3, 4, 1)}


def test_text_forms(spark):
    df = spark.createDataFrame([("clicks", "0:12,1:34"), ("one", "0:0"), ("fresh", None)], "topic string, offsets string")
    out = {tuple(r) for r in decode_offsets(df).collect()}
    assert out == {("clicks", 0, 12), ("clicks", 1, 34), ("one", 0, 0)}
    points = decode_offsets(df.where("topic = 'clicks'"))
    assert starting_offsets(points) == '{"clicks":{"0":12,"1":34}}'
    assert starting_offsets(decode_offsets(df.where("topic = 'fresh'"))) is None


def test_partitions_without_a_point_start_at_the_beginning(spark):
    points = spark.createDataFrame([("t", 1, 7)], POINTS)
    assert json.loads(starting_offsets(points, {"t": 3, "u": 1})) == {"t": {"0": -2, "1": 7, "2": -2}, "u": {"0": -2}}


_points = st.dictionaries(
    st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 12)), st.integers(0, 2**60), min_size=1, max_size=12
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(_points)
def test_round_trip(spark, points):
    rows = [(t, p, o) for (t, p), o in points.items()]
    out = decode_offsets(encode_offsets(spark.createDataFrame(rows, POINTS), "offset")).collect()
    assert {tuple(r) for r in out} == set(rows)


def test_resume(spark, make_messages):
    rows = [(t, p, o, 1, f"{t}{p}{o}") for t in ("A", "B") for p in (0, 1) for o in range(150)]
    points = spark.createDataFrame([("A", 0, 100), ("A", 1, 0), ("B", 0, 500)], POINTS)
    out = resume_from(make_messages(rows), points)
    kept = sorted((r["topic"], r["partition"], r["offset"]) for r in out.collect())
    expected = [("A", 0, o) for o in range(100, 150)] + [(t, 1, o) for t in ("A", "B") for o in range(150)]
    assert kept == sorted(expected)


_odd_points = st.lists(
    st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from([0, 1, None]), st.sampled_from([None, 0, 2, 3, 9])), max_size=8
)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_resume_with_repeated_and_null_points(spark, make_messages, threshold):
    rows = [(t, p, o, 1, f"{t}{p}{o}") for t in ("A", "B", None) for p in (0, 1, None) for o in (0, 1, 2, 3, None)]
    messages = make_messages(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(_odd_points)
    def check(points):
        start = {}
        for t, p, o in points:
            if o is not None:
                start[t, p] = max(o, start.get((t, p), o))
        expected = [v for t, p, o, _, v in rows if (t, p) not in start or o is None or o >= start[t, p]]
        out = resume_from(messages, spark.createDataFrame(points, POINTS))
        assert sorted(r["value"] for r in out.collect()) == sorted(expected)

    try:
        check()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_resume_without_points_is_everything(spark, make_messages):
    messages = make_messages([("A", 0, 1, 1, "x")])
    assert resume_from(messages, spark.createDataFrame([], POINTS)).count() == 1


def test_ledger(spark, make_messages, tmp_path):
    path = f"{tmp_path}/ledger"
    first = make_messages([("A", 0, o, 0, "x") for o in range(5)])
    second = make_messages([("A", 0, o, 0, "x") for o in range(5, 8)] + [("A", 1, 0, 0, "x")])
    write_ledger(first, 0, path)
    write_ledger(second, 1, path)
    write_ledger(second, 1, path)
    ledger = read_ledger(spark, path)
    assert ledger.count() == 3
    assert {tuple(r) for r in latest_offsets(ledger).collect()} == {("A", 0, 8), ("A", 1, 1)}
    both = first.union(second)
    assert resume_from(both, latest_offsets(ledger)).count() == 0


def looped_islands(offsets):
    """Stretches without a gap as (first, one past the last, messages)."""
    out = []
    for offset in sorted(offsets):
        if out and offset <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], offset + 1), out[-1][2] + 1)
        else:
            out.append((offset, offset + 1, 1))
    return out


@pytest.mark.parametrize("block", [1, 2, 7, 64, 10**6])
def test_islands_and_gaps_against_a_loop(spark, make_messages, block):
    rng = random.Random(block)
    places = {("A", 0): [rng.randrange(300) for _ in range(250)], ("A", 1): list(range(500)), ("B", 0): [0, 2, 2, 2, 9, 700], (None, None): [5, 6]}
    rows = [(t, p, o, 0, "x") for (t, p), offsets in places.items() for o in offsets]
    rng.shuffle(rows)
    messages = make_messages([*rows, ("A", 0, None, 0, "x")])
    islands = offset_islands(messages, block)
    got, missing = {}, {}
    for r in islands.collect():
        got.setdefault((r["topic"], r["partition"]), []).append((r["from_offset"], r["until_offset"], r["n"]))
    expected = {place: looped_islands(offsets) for place, offsets in places.items()}
    assert {k: sorted(v) for k, v in got.items()} == expected
    for r in offset_gaps(messages, block).collect():
        assert r["n"] == r["until_offset"] - r["from_offset"]
        missing.setdefault((r["topic"], r["partition"]), []).append((r["from_offset"], r["until_offset"]))
    holes = {k: [(a[1], b[0]) for a, b in zip(v, v[1:])] for k, v in expected.items()}
    assert {k: sorted(v) for k, v in missing.items()} == {k: v for k, v in holes.items() if v}
    safe = {(r["topic"], r["partition"]): r["offset"] for r in safe_offsets(islands).collect()}
    assert safe == {k: v[0][1] for k, v in expected.items()}


def test_islands_of_batches_become_those_of_all(spark, make_messages, tmp_path):
    rng = random.Random(2)
    rows = [("A", p, o, 0, "x") for p in (0, 1) for o in range(200) if rng.random() < 0.8]
    rng.shuffle(rows)
    for batch in range(5):
        write_ledger(make_messages(rows[batch::5]), batch, f"{tmp_path}/ledger", islands=True)
    write_ledger(make_messages(rows[0::5]), 0, f"{tmp_path}/ledger", islands=True)  # run again
    merged = merge_ranges(read_ledger(spark, f"{tmp_path}/ledger"))
    whole = offset_islands(make_messages(rows))
    assert sorted(map(tuple, merged.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_a_busy_partition_is_many_groups_in_one_shuffle_of_messages(spark, make_messages):
    plan = offset_islands(make_messages([("A", 0, 1, 0, "x")]))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("_block" in line for line in exchanges[-1:]) and "SinglePartition" not in plan


def test_overlapping_ranges_merge(spark):
    rows = [("A", 0, 0, 5, 5), ("A", 0, 3, 4, 1), ("A", 0, 5, 8, 3), ("A", 0, 9, 10, 1), ("A", 1, 0, 1, 1)]
    ranges = spark.createDataFrame(rows, "topic string, partition int, from_offset long, until_offset long, n long")
    got = sorted(tuple(r) for r in merge_ranges(ranges).collect())
    assert got == [("A", 0, 0, 8, 9), ("A", 0, 9, 10, 1), ("A", 1, 0, 1, 1)]
