"""Operators with state: zero windows, running values, answers and single deliveries on streams."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators.archive import window_concat
from millrace.operators.events import to_events
from millrace.operators.pairs import answers
from millrace.operators.windows import window_counts
from millrace.sources.messages import before, closing_messages, once
from millrace.streaming import sinks
from millrace.streaming.run import ROCKSDB, run_to_end
from millrace.streaming.state import dense_window_counts, running_values, whole_keys
from tests.test_streams import Inbox, rows

EPOCH_2024 = 1_704_067_200
EVENT = '{"eid":"%s","passport":{"sid":"%s"},"userId":"%s"}'


@pytest.fixture
def inbox(spark, make_messages, tmp_path):
    return Inbox(spark, make_messages, tmp_path)


def keep(path):
    return lambda batch, batch_id: sinks.replace_batch(batch, batch_id, path)


def second(name):
    return (F.unix_micros(name) / 1_000_000 - EPOCH_2024).cast("double").alias(name)


def dense(spark, inbox, tmp_path, window=10, slide=4, name="dense", **options):
    """Every delivered message counted as a stream, one file a batch; (group.., start, counts..) and the last progress."""
    live = inbox.stream().withWatermark("timestamp", "5 seconds")
    out = dense_window_counts(live, window, slide, **options)
    query = run_to_end(out, keep(f"{tmp_path}/{name}"), f"{tmp_path}/ck-{name}", state_store=ROCKSDB)
    got = spark.read.parquet(f"{tmp_path}/{name}")
    by = list(options.get("by", ()))
    columns = [*by, second("window_start"), *[c for c in out.columns if c not in (*by, "window_start", "window_end")]]
    return sorted(map(tuple, got.select(columns).collect())), query


def test_zero_windows_come_when_the_watermark_passes(spark, inbox, tmp_path):
    inbox.deliver([("A", 0, n, s, "x") for n, s in enumerate((1, 2, 30))])
    first, _ = dense(spark, inbox, tmp_path)
    # the watermark is 25: windows to 22 are closed, the empty ones before it included
    assert [r[0] for r in first] == [-8.0, -4.0, 0.0, 4.0, 8.0, 12.0]
    assert [r[1] for r in first] == [1, 2, 2, 0, 0, 0]
    inbox.deliver([("A", 0, 9, 61, "x")])  # a batch without rows for the windows it closes
    second_, _ = dense(spark, inbox, tmp_path)
    assert [r[0] for r in second_] == [-8.0 + 4 * n for n in range(14)]
    assert {r[0]: r[1] for r in second_ if r[1]} == {-8.0: 1, -4.0: 2, 0.0: 2, 24.0: 1, 28.0: 1}


@pytest.mark.parametrize("window,slide", [(10, 4), (5, None), (2, 6)])
def test_dense_stream_equals_the_table(spark, inbox, tmp_path, window, slide):
    rng = random.Random(window)
    times = sorted(rng.choice([rng.randrange(40), rng.randrange(150, 200)]) + 0.5 for _ in range(60))
    for n in range(3):
        inbox.deliver([("A" if s < 20 or rng.random() < 0.5 else "B", 0, n * 100 + i, s, EVENT % ("u", "s", "u")) for i, s in enumerate(times[n * 20 : n * 20 + 20])])
    expected = window_counts(to_events(inbox.table()), window, slide, ts="arrived", by=["topic"], kinds={"u": "u"}, dense=True)
    expected = sorted(map(tuple, expected.select("topic", second("window_start"), "count", "u").collect()))
    inbox.deliver([("close", 0, 0, 1_000, "{}")])
    live = to_events(inbox.stream().withWatermark("timestamp", "5 seconds"))
    out = dense_window_counts(live, window, slide, ts="arrived", by=["topic"], kinds={"u": "u"})
    run_to_end(out, keep(f"{tmp_path}/out"), f"{tmp_path}/ck", state_store=ROCKSDB)
    got = spark.read.parquet(f"{tmp_path}/out").select("topic", second("window_start"), "count", "u").collect()
    got = sorted(tuple(r) for r in got if r["topic"] != "close")
    assert len(got) == len(set(r[:2] for r in got))
    last = {t: max(r[1] for r in expected if r[0] == t) for t in ("A", "B")}
    assert [r for r in got if r[1] <= last[r[0]]] == expected
    assert all(r[2:] == (0, 0) for r in got if r[1] > last[r[0]])  # and it goes on


def test_a_group_that_is_idle_loses_its_state_until_it_comes_back(spark, inbox, tmp_path):
    inbox.deliver([("A", 0, 0, 1, "x"), ("B", 0, 0, 2, "x")])
    inbox.deliver([("B", 0, n, s, "x") for n, s in enumerate((100, 200))])
    inbox.deliver([("A", 0, 1, 300, "x"), ("B", 0, 5, 420, "x")])
    inbox.deliver([("B", 0, 6, 500, "x")])
    got, query = dense(spark, inbox, tmp_path, 10, 10, by=["topic"], idle="40 seconds")
    starts = defaultdict(list)
    for topic, start, count in got:
        starts[topic].append((start, count))
    assert starts["A"] == [(0.0, 1), (10.0, 0), (20.0, 0), (30.0, 0), (40.0, 0), (300.0, 1), (310.0, 0), (320.0, 0), (330.0, 0), (340.0, 0)]
    assert [c for _, c in starts["B"] if c] == [1, 1, 1, 1]


def test_dense_streams_are_for_streams(inbox):
    inbox.deliver([("A", 0, 0, 1, "x")])
    with pytest.raises(ValueError):
        dense_window_counts(inbox.table())


def run_values(spark, inbox, path, **options):
    live = inbox.stream()
    live = live.withWatermark("timestamp", "1 second") if "idle" in options else live
    updates = running_values(live, "key", "value", **options)
    query = run_to_end(updates, sinks.updates_sink(f"{path}/out"), f"{path}/ck", mode="update", state_store=ROCKSDB)
    return sinks.read_updates(spark, f"{path}/out", ["key", "part"]), query


def keyed(rows):
    """Messages whose key is their topic."""
    return [(k, p, o, s, v) for k, p, o, s, v in rows]


def expected_values(rows):
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((s, f"{key}:{p}:{o:020}", v) for k, p, o, s, v in rows if k == key)
        out[key] = (len(mine), mine[0][2], mine[-1][2])
    return out


class Keyed(Inbox):
    """Deliveries whose key is the topic."""

    def __init__(self, spark, make_messages, root):
        super().__init__(spark, lambda rows, ntz: make_messages(rows, ntz).withColumn("key", F.col("topic")), root)


@pytest.mark.parametrize("places", [1, 16])
def test_running_values_over_deliveries_in_any_order(spark, make_messages, tmp_path, places):
    inbox = Keyed(spark, make_messages, tmp_path)
    rng = random.Random(places)
    data = [(rng.choice("aab"), n % 3, n, rng.randrange(100), f"v{n}") for n in range(150)]
    for n in range(3):
        inbox.deliver(data[n * 50 : n * 50 + 50])
        updates, _ = run_values(spark, inbox, tmp_path, places=places)
        got = {r["key"]: (r["n"], r["first"], r["last"]) for r in whole_keys(updates).collect()}
        assert got == expected_values(data[: n * 50 + 50])
    assert updates.where("key = 'a'").count() == (1 if places == 1 else updates.where("key = 'a'").select("part").distinct().count())


def test_running_values_go_on_from_an_earlier_run(spark, make_messages, tmp_path):
    data = [("ab"[n % 2], 0, n, n, f"v{n}") for n in range(20)] + [("c", 0, 99, 3, None)]
    old, new = Keyed(spark, make_messages, tmp_path / "old"), Keyed(spark, make_messages, tmp_path / "new")
    old.deliver(data[:9] + data[20:])
    new.deliver(data[9:20])
    before_, _ = run_values(spark, old, tmp_path / "old")
    after, _ = run_values(spark, new, tmp_path / "new", initial=before_)
    parts = after.unionByName(before_.join(after, ["key", "part"], "left_anti"))
    got = {r["key"]: (r["n"], r["first"], r["last"]) for r in whole_keys(parts).collect()}
    assert got == expected_values(data[:20]) | {"c": (1, None, None)}


def test_idle_keys_lose_their_state(spark, make_messages, tmp_path):
    inbox = Keyed(spark, make_messages, tmp_path)
    inbox.deliver([(k, 0, n, n, "v") for n, k in enumerate("abcdefgh")])
    inbox.deliver([("a", 0, 100, 500, "v")])
    inbox.deliver([("a", 0, 101, 510, "v"), ("b", 0, 102, 510, "w")])
    updates, query = run_values(spark, inbox, tmp_path, places=1, idle="60 seconds")
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) >= 8 and kept[-1] < 8
    got = {r["key"]: (r["n"], r["first"], r["last"]) for r in whole_keys(updates).collect()}
    assert got["b"] == (1, "w", "w")  # starts anew


def test_null_keys_are_keys(spark, inbox, tmp_path):
    inbox.deliver([("A", 0, n, n, f"v{n}") for n in range(4)])
    updates, _ = run_values(spark, inbox, tmp_path)
    (row,) = whole_keys(updates).collect()
    assert (row["key"], row["n"], row["first"], row["last"]) == (None, 4, "v0", "v3")


def test_answers_on_streams(spark, inbox, tmp_path):
    rng = random.Random(1)
    events = lambda first, last: [
        (("Q", "R")[n % 2], 0, n, n + rng.random() * 3, EVENT % ("e", "s", f"u{rng.randrange(3)}")) for n in range(first, last)
    ]
    for n in range(3):
        inbox.deliver(events(n * 40, n * 40 + 40))
    sides = lambda rows: [rows.where(F.col("topic") == t) for t in ("Q", "R")]
    for how in ("inner", "left"):
        expected = answers(*sides(to_events(inbox.table())), "userId", 6, how=how, ts="arrived", keep=["offset"])
        expected = sorted(map(str, expected.collect()))
        if how == "left":
            end = F.timestamp_seconds(F.lit(EPOCH_2024 + 1_000))
            closing = closing_messages(spark, end, "Q,R").collect()
            inbox.deliver([(r["topic"], 0, None, 1_000, r["value"]) for r in closing])
        live = inbox.stream().withWatermark("timestamp", "10 seconds")
        live = before(live, F.timestamp_seconds(F.lit(EPOCH_2024 + 1_000)))
        out = answers(*sides(to_events(live)), "userId", 6, how=how, ts="arrived", keep=["offset"])
        query = run_to_end(out, keep(f"{tmp_path}/{how}"), f"{tmp_path}/ck-{how}")
        got = spark.read.parquet(f"{tmp_path}/{how}").select(out.columns).collect()
        assert sorted(map(str, got)) == expected
        if how == "left":
            assert any(r["response_offset"] is None for r in got)
            assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 0  # nothing is kept for ever


def test_each_message_once(spark, inbox, tmp_path):
    data = rows(0, 60)
    inbox.deliver(data)
    inbox.deliver(data[::3] + rows(60, 80))
    inbox.deliver(data[40:] + data[40:])
    live = once(inbox.stream(), "1 hour").select("topic", "partition", "offset")
    run_to_end(live, keep(f"{tmp_path}/out"), f"{tmp_path}/ck")
    run_to_end(live, keep(f"{tmp_path}/out"), f"{tmp_path}/ck")
    got = sorted(tuple(r)[:3] for r in spark.read.parquet(f"{tmp_path}/out").select("topic", "partition", "offset").collect())
    assert got == sorted((t, p, o) for t, p, o, *_ in rows(0, 80))
    assert once(inbox.table(), "1 hour").count() == 80


def test_places_are_forgotten_behind_the_watermark(spark, inbox, tmp_path):
    for n in range(4):
        inbox.deliver(rows(n * 1_000, n * 1_000 + 30))
    query = run_to_end(once(inbox.stream(), "20 seconds"), "noop", f"{tmp_path}/ck")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 60


def test_a_table_keeps_messages_without_an_offset(make_messages):
    messages = make_messages([("A", 0, 1, 0, "x"), ("A", 0, 1, 0, "x"), ("A", 0, None, 0, "y"), ("A", 0, None, 0, "y")])
    assert sorted(r["value"] for r in once(messages, "1 hour").collect()) == ["x", "y", "y"]


def test_appended_concatenation_forgets_closed_windows(spark, inbox, tmp_path):
    for n in range(3):
        inbox.deliver(rows(n * 40, n * 40 + 40))
    expected = sorted(map(str, window_concat(inbox.table(), 30, segment_messages=8).collect()))
    inbox.deliver([("close", 0, 0, 10_000, "{}")])
    live = window_concat(inbox.stream().withWatermark("timestamp", "10 seconds"), 30, segment_messages=8)
    query = run_to_end(live, keep(f"{tmp_path}/out"), f"{tmp_path}/ck")
    got = spark.read.parquet(f"{tmp_path}/out").where("topic != 'close'").select(live.columns)
    assert sorted(map(str, got.collect())) == expected
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_messages_without_a_time_are_kept_as_rejects(spark, make_messages, tmp_path, fmt):
    timed = make_messages([("A", 0, 1, 5, "x")], ntz=False)
    lost = make_messages([("A", 0, 2, 5, "y")], ntz=False).withColumn("timestamp", F.lit(None).cast("timestamp"))
    sinks.archive_sink(f"{tmp_path}/a", 10, fmt=fmt, rejects=f"{tmp_path}/r")(timed.unionByName(lost), 0)
    read = sinks.read_archive if fmt == "parquet" else sinks.read_text_archive
    assert [r["value"] for r in read(spark, f"{tmp_path}/a").collect()] == ["x"]
    (row,) = sinks.read_rejects(spark, f"{tmp_path}/r").collect()
    assert (row["value"], row["offset"], row["timestamp"], row["reason"]) == ("y", 2, None, "NO_TIME")
