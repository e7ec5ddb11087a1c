"""The product's five jobs, each a few streams over one message source.

``messages`` is a streaming DataFrame from ``millrace.sources``. Each job returns
its running queries by name; wait on them or on ``spark.streams``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.events import tag_type, to_events
from millrace.operators.tokens import token_counts
from millrace.operators.windows import (
    COUNT_KINDS,
    COUNT_SLIDE,
    COUNT_WINDOW,
    Windows,
    label_counts,
    window_counts,
)
from millrace.sources.messages import subscribe, with_event_time
from millrace.streaming import sinks
from millrace.streaming.run import run_stream

Queries = dict[str, StreamingQuery]


def every_slide(window: str | int, slide: str | int | None) -> str:
    """A batch per slide, so that an archive gets one folder per topic and slide, not one per second."""
    return f"{max(Windows.of(window, slide).slide // 1_000, 1)} milliseconds"


def archive_job(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    window: str | int,
    slide: str | int | None = None,
    *,
    event_topics: tuple[str, ...] = ("PassportEvents",),
    fmt: str = "parquet",
    rows_per_file: int | None = None,
    trigger: str | None = None,
) -> Queries:
    """All topics to the archive, the events of some to Parquet, from one read.

    Messages without a time go to ``untimed``, those that are no events to ``rejects``.
    """
    store_events = sinks.events_sink(f"{root}/events", f"{root}/rejects", rows_per_file=rows_per_file)
    sink = sinks.fan_out(
        sinks.archive_sink(
            f"{root}/archive", window, slide, fmt=fmt, rows_per_file=rows_per_file, rejects=f"{root}/untimed"
        ),
        lambda batch, batch_id: store_events(subscribe(batch, event_topics), batch_id),
        sinks.ledger_sink(f"{root}/offsets"),
    )
    trigger = trigger or every_slide(window, slide)
    return {"archive": run_stream(messages, sink, checkpoint, trigger=trigger, name="archive")}


def search_job(
    messages: DataFrame,
    resource: str,
    checkpoint: str,
    *,
    path: str | None = None,
    connector: dict[str, str] | None = None,
    topics: tuple[str, ...] = ("PassportEvents",),
    trigger: str = "2 seconds",
) -> Queries:
    """Events to a search index: bulk files at ``path``, or a connector's options."""
    if (path is None) == (connector is None):
        raise ValueError("give either a path for bulk files or the options of a connector")
    sink = sinks.bulk_sink(path, resource) if path else sinks.connector_sink(resource, connector)
    return {"search": run_stream(subscribe(messages, topics), sink, checkpoint, trigger=trigger, name="search")}


def word_count_job(
    messages: DataFrame, checkpoint: str, *, sink="console", topics: tuple[str, ...] = ("PassportEvents",)
) -> Queries:
    """Running token counts of a topic."""
    counted = token_counts(subscribe(messages, topics))
    return {"words": run_stream(counted, sink, checkpoint, mode="complete", name="words")}


def resume_job(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    window: str | int = "30 seconds",
    slide: str | int | None = None,
    *,
    fmt: str = "parquet",
    rows_per_file: int | None = None,
    trigger: str | None = None,
) -> Queries:
    """The archive with an offset ledger written after each batch's data.

    A restart goes on from the checkpoint. To start elsewhere on purpose, give
    ``sources.offsets.starting_offsets`` of the ledger to the Kafka reader, with a
    new checkpoint and a new root.
    """
    sink = sinks.fan_out(
        sinks.archive_sink(
            f"{root}/archive", window, slide, fmt=fmt, rows_per_file=rows_per_file, rejects=f"{root}/untimed"
        ),
        sinks.ledger_sink(f"{root}/offsets"),
    )
    trigger = trigger or every_slide(window, slide)
    return {"resume": run_stream(messages, sink, checkpoint, trigger=trigger, name="resume")}


def counts_job(
    messages: DataFrame,
    checkpoint: str,
    *,
    dump_path: str,
    counts_sink="console",
    counted_topic: str = "PassportEvents",
    window: str | int = COUNT_WINDOW,
    slide: str | int = COUNT_SLIDE,
    watermark: str | None = None,
    trigger: str = "2 seconds",
) -> Queries:
    """Sliding counts per topic, first rows on the console and a raw dump.

    By default windows are counted in update mode and kept, so no late row is lost.
    With a ``watermark`` finished windows are emitted once and their state goes;
    rows later than that are dropped, and the progress of the query counts them
    as ``numRowsDroppedByWatermark``.
    """
    chosen = subscribe(messages, [counted_topic])
    if watermark:
        messages = with_event_time(messages).withWatermark("timestamp", watermark)
    events = tag_type(to_events(messages))
    counted = label_counts(
        window_counts(events, window, slide, ts="arrived", by=["topic", "type"], kinds=COUNT_KINDS)
    )
    return {
        "counts": run_stream(
            counted,
            counts_sink,
            f"{checkpoint}/counts",
            trigger=trigger,
            mode="append" if watermark else "update",
            name="counts",
        ),
        "first": run_stream(
            chosen.select("key", F.col("value")), "console", f"{checkpoint}/first", trigger=trigger, name="first"
        ),
        "dump": run_stream(
            chosen, sinks.dump_sink(dump_path), f"{checkpoint}/dump", trigger=trigger, name="dump"
        ),
    }
