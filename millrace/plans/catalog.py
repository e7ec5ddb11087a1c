"""The registered queries: every operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.durations import epoch_micros, from_micros
from millrace.functions.text import pair
from millrace.operators import archive, documents, events, offsets, pairs, running, tokens, windows
from millrace.plans.oracle import SQL
from millrace.session import work_dir
from millrace.sources import messages as source
from millrace.sources.offsets import read_ledger
from millrace.streaming import compaction, progress, sinks, state
from millrace.streaming.run import ROCKSDB, run_to_end

Query = Callable[[SparkSession, str], DataFrame]

CATALOG: dict[str, Query] = {}

# A batch is kept while several sinks read it, so its size is limited.
FILES_PER_BATCH = 1_000

SUBSCRIBED = "RawEvents,PassportEvents,SessionsRes"


def query(build: Query) -> Query:
    """Register a query under its function's name."""
    CATALOG[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table read as a stream of files, in batches of a bounded number of them.

    The table is a file or a folder of files. As a pattern its path may be either.
    """
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def sample(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """The event table as messages."""
    return source.messages_from_events(table(spark, sf_dir, "events"), dirty)


def sample_stream(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return source.messages_from_events(stream(spark, sf_dir, "events"), dirty)


# Sources


@query
def message_values(spark, sf_dir):
    return sample(spark, sf_dir).select("topic", "partition", "offset", "value")


@query
def messages_by_topic(spark, sf_dir):
    return sample(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("n"))


@query
def topic_subset(spark, sf_dir):
    return source.subscribe(sample(spark, sf_dir), SUBSCRIBED)


@query
def first_messages(spark, sf_dir):
    return source.first_rows(sample(spark, sf_dir)).select("topic", "partition", "offset", "value")


# Offsets


@query
def offset_ranges(spark, sf_dir):
    return offsets.offset_ranges(sample(spark, sf_dir))


@query
def offsets_encoded(spark, sf_dir):
    return offsets.encode_offsets(offsets.offset_ranges(sample(spark, sf_dir)))


@query
def offsets_roundtrip(spark, sf_dir):
    return offsets.decode_offsets(offsets.encode_offsets(offsets.offset_ranges(sample(spark, sf_dir))))


@query
def resume_from(spark, sf_dir):
    """Go on after a batch that covered everything up to the middle of the month."""
    messages = sample(spark, sf_dir)
    covered = messages.where(F.col("timestamp") < F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'"))
    points = offsets.latest_offsets(offsets.offset_ranges(covered))
    return offsets.resume_from(messages, points).select("topic", "partition", "offset", "value")


@query
def offset_islands(spark, sf_dir):
    """Blocks small enough that stretches end inside them and go on beyond them."""
    return offsets.offset_islands(sample(spark, sf_dir), block_offsets=16)


@query
def offset_gaps(spark, sf_dir):
    return offsets.offset_gaps(sample(spark, sf_dir), block_offsets=16)


@query
def safe_offsets(spark, sf_dir):
    return offsets.safe_offsets(offsets.offset_islands(sample(spark, sf_dir)))


# Events


@query
def event_projection(spark, sf_dir):
    return events.to_events(sample(spark, sf_dir))


@query
def event_projection_flat(spark, sf_dir):
    return events.to_events(sample(spark, sf_dir), sid_path="sid", event_type="flat")


@query
def event_projection_dirty(spark, sf_dir):
    return events.to_events(sample(spark, sf_dir, dirty=True))


@query
def event_quarantine(spark, sf_dir):
    return events.quarantine(sample(spark, sf_dir, dirty=True)).drop("key")


@query
def event_type_tag(spark, sf_dir):
    return events.tag_type(events.to_events(sample(spark, sf_dir)))


@query
def event_of_kind(spark, sf_dir):
    return events.of_kind(events.to_events(sample(spark, sf_dir)), ["upsert_session", "track_event"])


@query
def event_render(spark, sf_dir):
    tagged = events.tag_type(events.to_events(sample(spark, sf_dir)))
    return events.render_event(tagged).select("topic", "partition", "offset", "line")


@query
def event_render_compat(spark, sf_dir):
    tagged = events.tag_type(events.to_events(sample(spark, sf_dir)))
    return events.render_event(tagged, compat=True).select("topic", "partition", "offset", "line")


@query
def events_sql_view(spark, sf_dir):
    events.to_events(sample(spark, sf_dir)).createOrReplaceTempView("events")
    return spark.sql("SELECT eid, count(*) AS n, count(userId) AS n_users FROM events GROUP BY eid")


# Counts


@query
def count_sliding(spark, sf_dir):
    """The counts job's own window, 10 s every 4 s."""
    return windows.window_counts(sample(spark, sf_dir), "10 seconds", "4 seconds")


@query
def count_by_kind(spark, sf_dir):
    rows = events.to_events(sample(spark, sf_dir))
    return windows.window_counts(
        rows, "10 hours", "4 hours", ts="arrived", by=["topic"], kinds=windows.COUNT_KINDS
    )


@query
def count_tumbling(spark, sf_dir):
    rows = events.to_events(sample(spark, sf_dir))
    return windows.window_counts(rows, "1 day", ts="arrived", kinds=windows.COUNT_KINDS)


@query
def count_sampled(spark, sf_dir):
    return windows.window_counts(sample(spark, sf_dir), "2 hours", "6 hours")


@query
def count_dense(spark, sf_dir):
    """Per five minutes and topic, those without a message included."""
    return windows.window_counts(sample(spark, sf_dir), "5 minutes", by=["topic"], dense=True)


@query
def count_dense_by_type(spark, sf_dir):
    """Per five minutes and type tag, events without a tag as a group of their own."""
    rows = events.tag_type(events.to_events(sample(spark, sf_dir)))
    return windows.window_counts(rows, "5 minutes", ts="arrived", by=["type"], dense=True)


@query
def count_dense_sliding(spark, sf_dir):
    rows = events.to_events(sample(spark, sf_dir))
    return windows.window_counts(
        rows, "10 minutes", "4 minutes", ts="arrived", kinds=windows.COUNT_KINDS, dense=True
    )


@query
def count_labels(spark, sf_dir):
    rows = events.to_events(sample(spark, sf_dir))
    counted = windows.window_counts(rows, "10 hours", "4 hours", ts="arrived", kinds=windows.COUNT_KINDS)
    return windows.label_counts(counted)


@query
def window_runs(spark, sf_dir):
    """Messages and characters of the last day per topic, for a window that moves by a second."""
    rows = sample(spark, sf_dir).withColumn("chars", F.length("value").cast("bigint"))
    return running.window_runs(rows, "1 day", "1 second", {"chars": "chars"}, by=["topic"], block_windows=100_000)


@query
def window_sums(spark, sf_dir):
    """The same for ten minutes every four, each window by itself."""
    rows = sample(spark, sf_dir).withColumn("chars", F.length("value").cast("bigint"))
    runs = running.window_runs(rows, "10 minutes", "4 minutes", {"chars": "chars"}, by=["topic"])
    return running.each_window(runs, "10 minutes", "4 minutes")


@query
def cogroup_topics(spark, sf_dir):
    """Requests and responses of each user side by side, in segments of 64 offsets."""
    rows = events.to_events(sample(spark, sf_dir))
    sides = [rows.where(F.col("topic") == topic) for topic in (ASKED, ANSWERED)]
    grouped = pairs.cogroup(*sides, "userId", "eid", segment_rows=64)
    return grouped.withColumns({c: F.array_join(c, ",", "null") for c in ("left_values", "right_values")})


# Tokens


@query
def token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), "text")


@query
def token_counts_messages(spark, sf_dir):
    return tokens.token_counts(sample(spark, sf_dir))


# Concatenation and archive


@query
def concat_tumbling(spark, sf_dir):
    return archive.window_concat(sample(spark, sf_dir), "30 seconds")


@query
def concat_daily(spark, sf_dir):
    return archive.window_concat(sample(spark, sf_dir), "1 day")


@query
def concat_sliding(spark, sf_dir):
    return archive.window_concat(sample(spark, sf_dir), "10 hours", "4 hours")


@query
def concat_sampled(spark, sf_dir):
    return archive.window_concat(sample(spark, sf_dir), "2 hours", "6 hours")


@query
def concat_segments(spark, sf_dir):
    """Small segments, so that windows above and below the limit both occur."""
    return archive.window_concat(sample(spark, sf_dir), "1 day", segment_messages=32)


@query
def archive_rows(spark, sf_dir):
    return archive.window_archive(sample(spark, sf_dir), "10 hours", "4 hours")


@query
def archive_paths(spark, sf_dir):
    return archive.archive_paths(archive.window_archive(sample(spark, sf_dir), "1 hour"), "/archive")


# Documents and dumps


@query
def bulk_documents(spark, sf_dir):
    return documents.to_bulk_documents(table(spark, sf_dir, "documents"), "library", "doc_id")


@query
def bulk_event_documents(spark, sf_dir):
    return documents.event_documents(events.to_events(sample(spark, sf_dir)), "events/event", ignore_nulls=False)


@query
def bulk_map_documents(spark, sf_dir):
    pairs = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), "event_type", F.lit("props"), "props"
    )
    rows = table(spark, sf_dir, "events").select("event_id", pairs.alias("doc"))
    return documents.to_bulk_documents(rows, "spark/docs", "event_id", ["doc"])


@query
def raw_dump(spark, sf_dir):
    return sample(spark, sf_dir).select(pair(F.col("key"), F.col("value")).alias("line"))


# Streams, each run over the whole table and read back


@query
def token_counts_stream(spark, sf_dir):
    work = work_dir(spark, "tokens")
    counted = tokens.token_counts(stream(spark, sf_dir, "documents"), "text")
    run_to_end(counted, sinks.snapshot_sink(f"{work}/counts"), f"{work}/checkpoint", mode="complete")
    return sinks.read_snapshot(spark, f"{work}/counts")


@query
def stream_equals_batch(spark, sf_dir):
    """``count_by_kind`` as a stream."""
    work = work_dir(spark, "counts")
    rows = events.to_events(sample_stream(spark, sf_dir))
    counted = windows.window_counts(
        rows, "10 hours", "4 hours", ts="arrived", by=["topic"], kinds=windows.COUNT_KINDS
    )
    run_to_end(counted, sinks.snapshot_sink(f"{work}/counts"), f"{work}/checkpoint", mode="complete")
    return sinks.read_snapshot(spark, f"{work}/counts")


@query
def concat_stream(spark, sf_dir):
    work = work_dir(spark, "concat")
    texts = archive.window_concat(sample_stream(spark, sf_dir), "1 day", segment_messages=32)
    run_to_end(texts, sinks.snapshot_sink(f"{work}/texts"), f"{work}/checkpoint", mode="complete")
    return sinks.read_snapshot(spark, f"{work}/texts")


@query
def archive_stream(spark, sf_dir):
    work = work_dir(spark, "archive")
    sink = sinks.archive_sink(f"{work}/archive", "10 hours", "4 hours")
    run_to_end(sample_stream(spark, sf_dir), sink, f"{work}/checkpoint")
    return sinks.read_archive(spark, f"{work}/archive").drop("batch_id")


@query
def archive_text_stream(spark, sf_dir):
    """The historic layout, a folder per window, read back as messages."""
    work = work_dir(spark, "text")
    sink = sinks.archive_sink(f"{work}/archive", "1 day", fmt="text")
    run_to_end(sample_stream(spark, sf_dir), sink, f"{work}/checkpoint")
    return sinks.read_text_archive(spark, f"{work}/archive").drop("batch_id")


@query
def events_parquet_roundtrip(spark, sf_dir):
    work = work_dir(spark, "events")
    sink = sinks.events_sink(f"{work}/events", f"{work}/rejects")
    run_to_end(sample_stream(spark, sf_dir, dirty=True), sink, f"{work}/checkpoint")
    return sinks.read_events(spark, f"{work}/events").drop("batch_id")


@query
def bulk_stream(spark, sf_dir):
    work = work_dir(spark, "bulk")
    run_to_end(sample_stream(spark, sf_dir), sinks.bulk_sink(f"{work}/bulk", "events"), f"{work}/checkpoint")
    return spark.read.schema("value string").text(f"{work}/bulk").select("value")


@query
def dump_stream(spark, sf_dir):
    work = work_dir(spark, "dump")
    run_to_end(sample_stream(spark, sf_dir), sinks.dump_sink(f"{work}/dump"), f"{work}/checkpoint")
    return spark.read.schema("value string").text(f"{work}/dump").select(F.col("value").alias("line"))


@query
def ledger_stream(spark, sf_dir):
    """The resume points a run leaves behind."""
    work = work_dir(spark, "ledger")
    sink = sinks.fan_out(sinks.archive_sink(f"{work}/archive", "30 seconds"), sinks.ledger_sink(f"{work}/offsets"))
    run_to_end(sample_stream(spark, sf_dir), sink, f"{work}/checkpoint")
    return offsets.latest_offsets(read_ledger(spark, f"{work}/offsets"))


# Streams in several deliveries

# Days at which a delivery ends, and how late a message may be: a delivery's files come in any order.
DELIVERIES = ("2000-01-01", "2024-01-11", "2024-01-21", "2100-01-01")
LATE = timedelta(days=11)


def zoned(df: DataFrame) -> DataFrame:
    """Wall clock times, read as UTC in any session zone, as the zoned ones that a watermark needs."""
    utc = {c: F.timestamp_micros(epoch_micros(F.col(c), True)) for c, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(utc)


def wall_clock(df: DataFrame) -> DataFrame:
    """The reverse."""
    return df.withColumns({c: from_micros(F.unix_micros(c), True) for c, t in df.dtypes if t == "timestamp"})


def deliver(
    spark, sf_dir, work, run, *, messages=None, ntz=False, close: Callable[[datetime], datetime] | None = None
) -> None:
    """The sample's messages in three deliveries, each read to its end before the next comes.

    ``run`` is given the stream, with zoned times unless ``ntz``. With ``close`` closing messages follow, ``LATE`` after the time that
    ``close`` makes of the latest message's; they move the watermark to that time and are in no result.
    """
    folder = f"{work}/messages"
    rows = sample(spark, sf_dir) if messages is None else messages
    rows = rows if ntz else zoned(rows)
    latest = rows.agg(F.max(F.unix_micros("timestamp"))).first()[0] if close else None
    end = None
    if latest is not None:
        at = close(datetime(1970, 1, 1) + timedelta(microseconds=latest)) + LATE
        end = F.timestamp_micros(F.lit((at - datetime(1970, 1, 1)) // timedelta(microseconds=1)))

    def read() -> None:
        arrived = source.stored_messages(
            spark, folder, streaming=True, ntz=ntz, max_files_per_trigger=FILES_PER_BATCH
        )
        if close:
            arrived = arrived.withWatermark("timestamp", f"{LATE.days} days")
            arrived = arrived if end is None else source.before(arrived, end)
        run(arrived)

    days = F.col("timestamp").cast("date")
    for first, last in zip(DELIVERIES, DELIVERIES[1:]):
        rows.where((days >= F.lit(first).cast("date")) & (days < F.lit(last).cast("date"))).write.mode("append").parquet(folder)
        read()
    if end is not None:
        source.closing_messages(spark, end).write.mode("append").parquet(folder)
        read()


def appended(spark, path: str) -> DataFrame:
    return wall_clock(spark.read.parquet(path).drop("batch_id"))


def window_end(at: datetime, window: timedelta, slide: timedelta) -> datetime:
    """The end of the last window that holds ``at``."""
    start = datetime(1970, 1, 1) + (at - datetime(1970, 1, 1)) // slide * slide
    return start + window


@query
def restart_no_duplicates(spark, sf_dir):
    """Archive the month in three deliveries, stopping and starting again in between."""
    work = work_dir(spark, "restart")
    sink = sinks.archive_sink(f"{work}/archive", "1 day")
    deliver(spark, sf_dir, work, lambda arrived: run_to_end(arrived, sink, f"{work}/checkpoint"), ntz=True)
    return sinks.read_archive(spark, f"{work}/archive").drop("batch_id")


@query
def count_dense_stream(spark, sf_dir):
    """``count_dense_sliding`` as a stream: each window once, empty ones too, when it closes."""
    work = work_dir(spark, "dense")
    window, slide = timedelta(minutes=10), timedelta(minutes=4)

    def run(arrived):
        rows = events.to_events(arrived)
        dense = state.dense_window_counts(rows, window, slide, ts="arrived", kinds=windows.COUNT_KINDS)
        sink = lambda batch, batch_id: sinks.replace_batch(batch, batch_id, f"{work}/counts")
        run_to_end(dense, sink, f"{work}/checkpoint", state_store=ROCKSDB)

    deliver(spark, sf_dir, work, run, close=lambda at: window_end(at, window, slide))
    return appended(spark, f"{work}/counts")


@query
def running_sessions_stream(spark, sf_dir):
    """Each session's number of events and its first and last kind, kept up to date over the deliveries."""
    work = work_dir(spark, "running")

    def run(arrived):
        updates = state.running_values(events.to_events(arrived), "sessionId", "eid", ts="arrived")
        run_to_end(updates, sinks.updates_sink(f"{work}/parts"), f"{work}/checkpoint", mode="update", state_store=ROCKSDB)

    deliver(spark, sf_dir, work, run)
    whole = state.whole_keys(sinks.read_updates(spark, f"{work}/parts", ["key", "part"]))
    return wall_clock(whole.withColumnRenamed("key", "sessionId"))


ASKED, ANSWERED, ANSWER_TIME = "RecommendationReq", "RecommendationRes", "12 hours"


def _answers(rows: DataFrame, how: str) -> DataFrame:
    sides = [rows.where(F.col("topic") == topic) for topic in (ASKED, ANSWERED)]
    return pairs.answers(*sides, "userId", ANSWER_TIME, how=how, ts="arrived")


@query
def answers_inner(spark, sf_dir):
    """Recommendation requests with the responses of the same user within half a day."""
    return _answers(events.to_events(sample(spark, sf_dir)), "inner")


@query
def answers_outer(spark, sf_dir):
    """The same with the requests that nothing answers."""
    return _answers(events.to_events(sample(spark, sf_dir)), "left")


def _answers_stream(spark, sf_dir, how):
    work = work_dir(spark, f"answers-{how}")

    def run(arrived):
        sink = lambda batch, batch_id: sinks.replace_batch(batch, batch_id, f"{work}/pairs")
        run_to_end(_answers(events.to_events(arrived), how), sink, f"{work}/checkpoint")

    deliver(spark, sf_dir, work, run, close=lambda at: at + timedelta(days=2))
    return appended(spark, f"{work}/pairs")


@query
def answers_inner_stream(spark, sf_dir):
    """Two streams joined, each remembering half a day of the other."""
    return _answers_stream(spark, sf_dir, "inner")


@query
def answers_outer_stream(spark, sf_dir):
    """The same, with unanswered requests once their time is over."""
    return _answers_stream(spark, sf_dir, "left")


@query
def concat_append_stream(spark, sf_dir):
    """Concatenation in append mode: each window's texts once it is closed, then its state goes."""
    work = work_dir(spark, "append")

    def run(arrived):
        sink = lambda batch, batch_id: sinks.replace_batch(batch, batch_id, f"{work}/texts")
        run_to_end(archive.window_concat(arrived, "1 day", segment_messages=32), sink, f"{work}/checkpoint")

    deliver(spark, sf_dir, work, run, close=lambda at: at + timedelta(days=1))
    return appended(spark, f"{work}/texts")


@query
def redelivered_stream(spark, sf_dir):
    """A third of the messages comes twice, once more in a later delivery; each stays once."""
    work = work_dir(spark, "again")
    messages = zoned(sample(spark, sf_dir))
    again = messages.where(F.col("offset") % 3 == 0)
    rows = messages.unionByName(again)

    def run(arrived):
        kept = source.once(arrived, f"{LATE.days} days").select("topic", "partition", "offset", "value")
        sink = lambda batch, batch_id: sinks.replace_batch(batch, batch_id, f"{work}/kept")
        run_to_end(kept, sink, f"{work}/checkpoint")

    deliver(spark, sf_dir, work, run, messages=rows)
    # The last delivery comes whole once more.
    days = F.col("timestamp").cast("date")
    messages.where(days >= F.lit(DELIVERIES[-2]).cast("date")).write.mode("append").parquet(f"{work}/messages")
    run(source.stored_messages(spark, f"{work}/messages", streaming=True, max_files_per_trigger=FILES_PER_BATCH))
    return appended(spark, f"{work}/kept")


@query
def archive_untimed_stream(spark, sf_dir):
    """Messages without a time are in no window, and are kept beside the archive."""
    work = work_dir(spark, "untimed")
    at = F.when(F.col("offset") % 7 != 0, F.col("timestamp"))
    messages = zoned(sample_stream(spark, sf_dir).withColumn("timestamp", at))
    sink = sinks.archive_sink(f"{work}/archive", "1 day", rejects=f"{work}/rejects")
    run_to_end(messages, sink, f"{work}/checkpoint")
    columns = ["topic", "partition", "offset", "value", "reason"]
    kept = sinks.read_archive(spark, f"{work}/archive").withColumn("reason", F.lit(None).cast("string"))
    return kept.select(*columns).unionByName(sinks.read_rejects(spark, f"{work}/rejects").select(*columns))


@query
def ledger_islands_stream(spark, sf_dir):
    """What the deliveries of a run cover together, without hiding what never came."""
    work = work_dir(spark, "islands")
    sink = sinks.ledger_sink(f"{work}/offsets", islands=True)
    deliver(spark, sf_dir, work, lambda arrived: run_to_end(arrived, sink, f"{work}/checkpoint"), ntz=True)
    return offsets.merge_ranges(read_ledger(spark, f"{work}/offsets"))


@query
def archive_compacted_stream(spark, sf_dir):
    """The archive with the files of its first two batches packed, read as one with those after."""
    work = work_dir(spark, "compact")
    sink = sinks.archive_sink(f"{work}/archive", "1 day")
    place = (f"{work}/archive", f"{work}/packed", sinks.ARCHIVE_SCHEMA)
    deliver(spark, sf_dir, work, lambda arrived: run_to_end(arrived, sink, f"{work}/checkpoint"), ntz=True)
    for upto_batch in (0, 1):
        compaction.compact(spark, *place, upto_batch, ["topic", "dt"])
    return compaction.read_compacted(spark, *place).select(*archive.ARCHIVE_COLUMNS)


@query
def progress_stream(spark, sf_dir):
    """What the sources of a run say they gave, batch by batch, late rows included."""
    work = work_dir(spark, "progress")
    listener = progress.ProgressLedger(spark, f"{work}/progress")

    def run(arrived):
        counted = windows.window_counts(source.subscribe(arrived, SUBSCRIBED), "1 day")
        sink = lambda batch, batch_id: sinks.replace_batch(batch, batch_id, f"{work}/counts")
        run_to_end(counted, sink, f"{work}/checkpoint")

    spark.streams.addListener(listener)
    try:
        deliver(spark, sf_dir, work, run, close=lambda at: at + timedelta(days=1))
        progress.wait_for_listeners(spark)
    finally:
        spark.streams.removeListener(listener)
    told = progress.read_progress(spark, f"{work}/progress").where(F.col("source").contains(work))
    return told.agg(F.sum("n").alias("n"), F.sum("late").alias("late"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to events to sliding counts: the product's main path in one query."""
    rows = events.to_events(sample(spark, sf_dir))
    return windows.window_counts(
        rows, windows.COUNT_WINDOW, windows.COUNT_SLIDE, ts="arrived", kinds=windows.COUNT_KINDS
    )


def check() -> None:
    """Every registered query has a statement to be compared with, and the reverse."""
    missing = set(CATALOG) ^ set(SQL)
    if missing:
        raise AssertionError(f"queries and statements differ: {sorted(missing)}")
