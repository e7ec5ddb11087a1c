"""Windowed concatenation and archive rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime

import pytest

from millrace.operators.archive import archive_paths, window_archive, window_concat


def test_separator_and_order(make_messages):
    rows = [("A", 1, 0, 1, "m3"), ("A", 0, 1, 5, "m2"), ("A", 0, 0, 9, "m1"), ("B", 0, 0, 2, "alone")]
    out = sorted(window_concat(make_messages(rows), "30 seconds").collect(), key=lambda r: (r["topic"], r["partition"]))
    assert [(r["topic"], r["partition"], r["segment"], r["n"], r["value"]) for r in out] == [
        ("A", 0, 0, 2, "m1/nm2"),
        ("A", 1, 0, 1, "m3"),
        ("B", 0, 0, 1, "alone"),
    ]


def test_messages_without_offset_stay_and_spread(make_messages):
    rows = [("A", 0, None, 1, f"m{i}") for i in range(300)] + [("A", 0, 3, 1, "x"), (None, None, None, 1, None)]
    out = window_concat(make_messages(rows), 30).collect()
    assert sum(r["n"] for r in out) == 302 and max(r["n"] for r in out) < 10
    assert all((r["segment"] < 0) == (r["value"] != "x") for r in out)


def test_one_scan_and_one_exchange(spark, make_messages, tmp_path):
    make_messages([("A", 0, o, o, "x") for o in range(10)]).write.parquet(f"{tmp_path}/m")
    plan = window_concat(spark.read.parquet(f"{tmp_path}/m"), "10 seconds", "4 seconds")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_own_separator_with_quote(make_messages):
    rows = [("A", 0, 0, 0, "x"), ("A", 0, 1, 0, "y")]
    assert window_concat(make_messages(rows), 30, separator="'\\").first()["value"] == "x'\\y"


def test_missing_text_reads_null(make_messages):
    rows = [("A", 0, 0, 0, None), ("A", 0, 1, 0, "y")]
    assert window_concat(make_messages(rows), 30).first()["value"] == "null/ny"


@pytest.mark.parametrize("window,slide", [(30, None), (10, 4), (2, 6)])
@pytest.mark.parametrize("limit", [1, 5, 1_000])
def test_segments_joined_are_the_window(make_messages, window, slide, limit):
    rng = random.Random(limit)
    rows = [("hot" if rng.random() < 0.7 else "cold", rng.randrange(3), i, rng.random() * 60, f"m{i}") for i in range(200)]
    out = window_concat(make_messages(rows), window, slide, segment_messages=limit).collect()
    step = slide or window
    expected = defaultdict(list)
    base = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds())
    for topic, partition, offset, seconds, value in rows:
        at = base + seconds
        k = int(at // step)
        starts = [(k + 1) * step - window] if step > window else [(k - i) * step for i in range(-(-window // step))]
        for start in starts:
            if start <= at < start + window:
                expected[topic, start].append((partition, offset, value))
    got = defaultdict(list)
    for r in out:
        start = int((r["window_start"] - datetime(1970, 1, 1)).total_seconds())
        assert r["n"] <= limit
        got[r["topic"], start].append((r["partition"], r["segment"], r["n"], r["value"]))
    assert set(got) == set(expected)
    for key, parts in got.items():
        text = "/n".join(p[3] for p in sorted(parts))
        assert text == "/n".join(v for _, _, v in sorted(expected[key]))


def test_no_message_no_row(make_messages):
    assert window_concat(make_messages([]), 30).count() == 0
    assert window_archive(make_messages([]), 30).count() == 0


def test_archive_place_is_the_window_end(make_messages):
    rows = [("A", 0, 0, 86_399, "late in the day"), ("A", 0, 1, 10, "x"), ("A", 0, 2, 12, "y")]
    archived = window_archive(make_messages(rows), "30 seconds")
    paths = {r["path"]: r["n"] for r in archive_paths(archived, "/root/").collect()}
    assert paths == {"/root/A/2024/01/01/1704067230000": 2, "/root/A/2024/01/02/1704153600000": 1}


def test_zoned_and_wall_clock_times_agree(spark, make_messages):
    rows = [("A", 0, i, i * 7.25, f"m{i}") for i in range(20)]
    wall = window_archive(make_messages(rows), 10, 4).collect()
    zoned = window_archive(make_messages(rows, ntz=False), 10, 4).collect()
    assert sorted(map(tuple, wall)) == sorted(map(tuple, zoned))
