"""Streams: same result as a batch, restart, replay, late data, sinks."""

from __future__ import annotations

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators.archive import window_archive, window_concat
from millrace.operators.events import to_events
from millrace.operators.offsets import latest_offsets
from millrace.operators.tokens import token_counts
from millrace.operators.windows import window_counts
from millrace.sources.messages import stored_messages
from millrace.sources.offsets import read_ledger
from millrace.streaming import sinks
from millrace.streaming.run import run_stream, run_to_end

EVENT = '{"eid":"%s","passport":{"sid":"s"}}'


class Inbox:
    """A folder of message files, delivered one at a time with rising file times."""

    def __init__(self, spark, make_messages, root):
        self.spark, self.make, self.path, self.count = spark, make_messages, f"{root}/inbox", 0
        os.makedirs(self.path)

    def deliver(self, rows):
        staged = f"{self.path}-staged-{self.count}"
        self.make(rows, ntz=False).coalesce(1).write.parquet(staged)
        (part,) = glob.glob(f"{staged}/part-*.parquet")
        target = f"{self.path}/{self.count:04d}.parquet"
        os.link(part, target)
        stamp = time.time() - 1_000 + self.count * 10
        os.utime(target, (stamp, stamp))
        self.count += 1

    def stream(self, **kwargs):
        return stored_messages(self.spark, self.path, streaming=True, max_files_per_trigger=1, **kwargs)

    def table(self):
        return stored_messages(self.spark, self.path)


@pytest.fixture
def inbox(spark, make_messages, tmp_path):
    return Inbox(spark, make_messages, tmp_path)


def rows(first, last, topics=("RawEvents", "PassportEvents"), step=1.0):
    kinds = ("upsert_session", "track_event", "other")
    return [(topics[i % len(topics)], i % 3, i, i * step, EVENT % kinds[i % 3]) for i in range(first, last)]


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert sorted(map(tuple, left.select(columns).collect())) == sorted(map(tuple, right.select(columns).collect()))


@pytest.mark.parametrize("window,slide", [("30 seconds", None), ("10 seconds", "4 seconds"), ("2 seconds", "6 seconds")])
def test_complete_counts_equal_the_batch(spark, inbox, tmp_path, window, slide):
    for start in (0, 40, 80):
        inbox.deliver(rows(start, start + 40))
    kinds = {"u": "upsert_session"}

    def counts(messages):
        return window_counts(to_events(messages), window, slide, ts="arrived", by=["topic"], kinds=kinds)

    run_to_end(counts(inbox.stream()), sinks.snapshot_sink(f"{tmp_path}/out"), f"{tmp_path}/ck", mode="complete")
    same(sinks.read_snapshot(spark, f"{tmp_path}/out"), counts(inbox.table()))


@pytest.mark.parametrize("window,slide", [("30 seconds", None), ("10 seconds", "4 seconds"), ("2 seconds", "6 seconds")])
def test_appended_counts_are_final_and_complete(spark, inbox, tmp_path, window, slide):
    for start in (0, 40, 80):
        inbox.deliver(rows(start, start + 40))
    expected = window_counts(inbox.table(), window, slide).collect()
    inbox.deliver([("RawEvents", 0, 10_000, 100_000, "{}")])  # moves the watermark past every window
    live = window_counts(inbox.stream().withWatermark("timestamp", "20 seconds"), window, slide)
    query = run_to_end(
        live, lambda b, i: sinks.replace_batch(b, i, f"{tmp_path}/out"), f"{tmp_path}/ck"
    )
    dropped = [op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]]
    assert sum(dropped) == 0
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch_id").where("window_start < '2024-01-01 12:00:00'")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected))


def test_dense_counts_are_for_tables(inbox):
    with pytest.raises(ValueError):
        window_counts(inbox.stream(), "10 seconds", dense=True)


def test_running_token_counts(spark, inbox, tmp_path):
    inbox.deliver([("A", 0, 0, 0, "a b a "), ("A", 0, 1, 0, None)])
    out, ck = f"{tmp_path}/out", f"{tmp_path}/ck"
    run_to_end(token_counts(inbox.stream()), sinks.snapshot_sink(out), ck, mode="complete")
    inbox.deliver([("A", 0, 2, 0, "b  c")])
    run_to_end(token_counts(inbox.stream()), sinks.snapshot_sink(out), ck, mode="complete")
    got = {r["value"]: r["count"] for r in sinks.read_snapshot(spark, out).collect()}
    assert got == {"a": 2, "b": 2, "": 1, "c": 1}


def test_concatenation_in_segments(spark, inbox, tmp_path):
    for start in (0, 30):
        inbox.deliver(rows(start, start + 30))
    live = window_concat(inbox.stream(), 30, segment_messages=8)
    run_to_end(live, sinks.snapshot_sink(f"{tmp_path}/out"), f"{tmp_path}/ck", mode="complete")
    same(sinks.read_snapshot(spark, f"{tmp_path}/out"), window_concat(inbox.table(), 30, segment_messages=8))
    window = lambda df: {
        (t, e): "/n".join(v for _, _, v in sorted(parts))
        for t, e, parts in df.groupBy("topic", "window_end").agg(F.collect_list(F.struct("partition", "segment", "value"))).collect()
    }
    assert window(sinks.read_snapshot(spark, f"{tmp_path}/out")) == window(window_concat(inbox.table(), 30))


@pytest.mark.parametrize("rows_per_file", [None, 16])
def test_archive_restart_and_replay(spark, inbox, tmp_path, rows_per_file):
    root = f"{tmp_path}/archive"
    sink = sinks.archive_sink(root, 10, 4, rows_per_file=rows_per_file)
    inbox.deliver(rows(0, 50))
    run_to_end(inbox.stream(), sink, f"{tmp_path}/ck")
    inbox.deliver(rows(50, 80))
    inbox.deliver(rows(80, 120))
    run_to_end(inbox.stream(), sink, f"{tmp_path}/ck")
    expected = window_archive(inbox.table(), 10, 4)
    same(sinks.read_archive(spark, root).drop("batch_id"), expected)
    run_to_end(inbox.stream(), sink, f"{tmp_path}/ck-new")  # every batch again, from nothing
    same(sinks.read_archive(spark, root).drop("batch_id"), expected)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{root}/topic=*")) == ["topic=PassportEvents", "topic=RawEvents"]


def test_hot_folder_has_several_writers(spark, make_messages, tmp_path):
    hot = make_messages([("A", 0, i, i * 0.1, f"m{i}") for i in range(400)], ntz=False).coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would join such small partitions again
    try:
        for name, rows_per_file in (("as-read", None), ("gathered", 20)):
            sinks.archive_sink(f"{tmp_path}/{name}", "1 day", rows_per_file=rows_per_file)(hot, 0)
            files = glob.glob(f"{tmp_path}/{name}/topic=A/dt=2024-01-02/batch_id=0/part-*.parquet")
            assert (len(files) > 1) == (rows_per_file is not None)
            assert sinks.read_archive(spark, f"{tmp_path}/{name}").count() == 400
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_text_archive_holds_the_concatenation(spark, inbox, tmp_path):
    root = f"{tmp_path}/archive"
    inbox.deliver([("A", 0, 1, 2, "m2"), ("A", 0, 0, 3, "m1"), ("A", 1, 0, 1, "m3"), ("A", 0, 2, 31, "next")])
    run_to_end(inbox.stream(), sinks.archive_sink(root, 30, fmt="text"), f"{tmp_path}/ck")
    folder = f"{root}/topic=A/dt=2024-01-01/window_end_ms=1704067230000/batch_id=0"
    (part,) = glob.glob(f"{folder}/part-*")
    assert open(part).read() == "m1/nm2/nm3/n"
    got = sinks.read_text_archive(spark, root).select("value", "window_end_ms").collect()
    assert sorted(map(tuple, got)) == [
        ("m1", 1704067230000), ("m2", 1704067230000), ("m3", 1704067230000), ("next", 1704067260000)]


def test_empty_batches_leave_nothing(spark, make_messages, tmp_path):
    empty = make_messages([], ntz=False)
    for name, sink in {
        "archive": sinks.archive_sink(f"{tmp_path}/archive", 10),
        "events": sinks.events_sink(f"{tmp_path}/events", f"{tmp_path}/rejects"),
        "bulk": sinks.bulk_sink(f"{tmp_path}/bulk", "i"),
        "dump": sinks.dump_sink(f"{tmp_path}/dump"),
        "ledger": sinks.fan_out(sinks.ledger_sink(f"{tmp_path}/ledger")),
    }.items():
        sink(empty, 0)
        assert not os.path.exists(f"{tmp_path}/{name}")


def test_events_rejects_and_view(spark, inbox, tmp_path):
    seen = []
    good = rows(0, 9)
    inbox.deliver(good + [("RawEvents", 0, 100, 5, "not json"), ("RawEvents", 0, 101, 5, None)])

    def on_view(events, batch_id):
        sql = "SELECT eid, count(*) AS n FROM events GROUP BY eid"
        seen.extend(tuple(r) for r in events.sparkSession.sql(sql).collect())

    sink = sinks.events_sink(f"{tmp_path}/events", f"{tmp_path}/rejects", on_view=on_view)
    run_to_end(inbox.stream(), sink, f"{tmp_path}/ck")
    assert sorted(seen) == [("other", 3), ("track_event", 3), ("upsert_session", 3)]
    stored = sinks.read_events(spark, f"{tmp_path}/events")
    assert stored.where("eid IS NOT NULL AND sessionId = 's' AND email IS NULL").count() == 9
    assert {r["topic"] for r in stored.select("topic").distinct().collect()} == {"RawEvents", "PassportEvents"}
    rejects = sinks.read_rejects(spark, f"{tmp_path}/rejects").collect()
    assert {(r["offset"], r["reason"]) for r in rejects} == {(100, "MALFORMED_JSON"), (101, "NULL_MESSAGE")}


def test_fan_out_writes_the_ledger_last(spark, inbox, tmp_path):
    inbox.deliver(rows(0, 10))

    def failing(batch, batch_id):
        raise RuntimeError("disk full")

    ledger = sinks.ledger_sink(f"{tmp_path}/ledger")
    archive = sinks.archive_sink(f"{tmp_path}/archive", 10)
    with pytest.raises(Exception, match="disk full"):
        run_to_end(inbox.stream(), sinks.fan_out(archive, failing, ledger), f"{tmp_path}/ck")
    assert not os.path.exists(f"{tmp_path}/ledger")
    run_to_end(inbox.stream(), sinks.fan_out(archive, ledger), f"{tmp_path}/ck")
    points = latest_offsets(read_ledger(spark, f"{tmp_path}/ledger"))
    expected = inbox.table().groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
    same(points, expected)
    assert sinks.read_archive(spark, f"{tmp_path}/archive").count() == 10


def test_bulk_and_dump_files(spark, inbox, tmp_path):
    inbox.deliver(rows(0, 4))
    inbox.deliver(rows(4, 6))
    sink = sinks.fan_out(sinks.bulk_sink(f"{tmp_path}/bulk", "idx"), sinks.dump_sink(f"{tmp_path}/dump"))
    run_to_end(inbox.stream(), sink, f"{tmp_path}/ck")
    lines = [line for p in glob.glob(f"{tmp_path}/bulk/*/part-*") for line in open(p).read().splitlines()]
    assert len(lines) == 12 and sum('"_index":"idx"' in line for line in lines) == 6
    dump = spark.read.schema("value string").text(f"{tmp_path}/dump").select("value")
    assert sorted(r["value"] for r in dump.collect()) == sorted(f"(null,{r[4]})" for r in rows(0, 6))


def test_connector(spark, inbox, tmp_path):
    """Another format stands in for the connector, whose jar is not here."""
    inbox.deliver(rows(0, 3))
    run_to_end(inbox.stream(), sinks.connector_sink(f"{tmp_path}/idx", {"es.nodes": "h"}, fmt="json"), f"{tmp_path}/ck")
    got = spark.read.json(f"{tmp_path}/idx").orderBy("place").collect()
    assert [(r["place"], r["eid"]) for r in got] == [
        ("PassportEvents-1-1", "track_event"), ("RawEvents-0-0", "upsert_session"), ("RawEvents-2-2", "other")]


def test_built_in_sinks(spark, inbox, tmp_path):
    inbox.deliver(rows(0, 4))
    for sink in ("console", "noop"):
        run_to_end(inbox.stream(), sink, f"{tmp_path}/{sink}")
    run_to_end(inbox.stream(), "memory", f"{tmp_path}/memory", name="seen")
    assert spark.table("seen").count() == 4
    with pytest.raises(ValueError):
        run_stream(inbox.stream(), "noop", "")


def test_half_written_snapshot_is_not_read(spark, tmp_path):
    sink = sinks.snapshot_sink(f"{tmp_path}/out")
    sink(spark.range(10), 0)
    sink(spark.range(20), 1)
    half = spark.range(3).selectExpr("id", "2L AS batch_id")
    half.write.mode("overwrite").parquet(f"{tmp_path}/out/data/slot=0")
    assert sinks.read_snapshot(spark, f"{tmp_path}/out").count() == 20
    sink(spark.range(7), 2)
    assert sinks.read_snapshot(spark, f"{tmp_path}/out").count() == 7


def test_files_are_bounded_with_adaptive_execution(spark, make_messages, tmp_path):
    sinks.archive_sink(f"{tmp_path}/a", "1 day", rows_per_file=5)(make_messages([("A", 0, o, 1, "x") for o in range(52)]), 0)
    files = list((tmp_path / "a").rglob("*.parquet"))
    assert len(files) >= 11 and sinks.read_archive(spark, f"{tmp_path}/a").count() == 52


def test_streams_read_folder_tables_in_several_batches(spark, tmp_path, monkeypatch):
    from millrace.plans import catalog

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "FILES_PER_BATCH", 2)
    live = catalog.stream(spark, str(tmp_path), "events")
    batches = []
    run_to_end(live, lambda batch, batch_id: batches.append(batch.count()), f"{tmp_path}/ck")
    assert sum(batches) == events.count() and len(batches) == 3
    one = catalog.stream(spark, "/root/testdata/sf0.001", "events")
    total = []
    run_to_end(one, lambda batch, batch_id: total.append(batch.count()), f"{tmp_path}/ck1")
    assert sum(total) == events.count()
