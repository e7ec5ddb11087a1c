"""Windowed concatenation and the archive of messages by topic, date and window."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import epoch_millis, is_ntz
from millrace.functions.text import shown
from millrace.operators.windows import Windows, bounds, with_window

# Fixed value: the two characters between messages, a slash and an n.
SEPARATOR = "/n"

# With the usual limit of 1 MB for a message, a segment stays below the 2 GB that
# one Spark string can hold.
SEGMENT_MESSAGES = 1_000

# Segments of a partition and window for messages that have no offset.
UNPLACED_SEGMENTS = 4_096

ARCHIVE_COLUMNS = ("topic", "dt", "window_end_ms", "partition", "offset", "value")


def _joined(separator: str, *order: str) -> Column:
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg(value, '{quoted}') WITHIN GROUP (ORDER BY {', '.join(f'`{c}`' for c in order)})")


def window_concat(
    messages: DataFrame,
    window: str | int | timedelta,
    slide: str | int | timedelta | None = None,
    *,
    separator: str = SEPARATOR,
    segment_messages: int = SEGMENT_MESSAGES,
    ts: str = "timestamp",
    start_offset: str | int | timedelta = 0,
) -> DataFrame:
    """The messages of each topic and window as texts of bounded length, in offset order.

    One row per ``segment_messages`` offsets of a partition, for windows of any
    size, in a batch and on a stream alike: joined by the separator in
    (partition, segment) order the rows of a window are its text. Messages without
    an offset have no order; they go to segments below zero by a hash of their
    text and time. One scan and one shuffle, by a key that no hot topic or window
    fills alone.
    """
    layout = Windows.of(window, slide, start_offset)
    ntz = is_ntz(messages, ts)
    unplaced = -1 - F.pmod(F.xxhash64("value", ts), F.lit(UNPLACED_SEGMENTS))
    segment = F.coalesce(F.call_function("div", F.col("offset"), F.lit(segment_messages)), unplaced)
    rows = with_window(messages, layout, ts).select(
        F.coalesce(F.col("topic"), F.lit("")).alias("topic"),
        "window",
        F.coalesce(F.col("partition"), F.lit(-1)).alias("partition"),
        F.coalesce(F.col("offset"), F.lit(-1)).alias("offset"),
        segment.alias("segment"),
        shown(F.col("value")).alias("value"),
    )
    segments = rows.groupBy("topic", "window", "partition", "segment").agg(
        F.count("*").alias("n"), _joined(separator, "offset").alias("value")
    )
    return segments.select("topic", *bounds(layout, ntz), "partition", "segment", "n", "value")


def window_archive(
    messages: DataFrame,
    window: str | int | timedelta,
    slide: str | int | timedelta | None = None,
    *,
    ts: str = "timestamp",
    start_offset: str | int | timedelta = 0,
) -> DataFrame:
    """Each message once per window, with the archive place it belongs to.

    The same content as ``window_concat``, kept as rows: nothing is shuffled or
    held, a hot topic stays spread over its partitions, and a late message is
    simply one more row of its window.
    """
    layout = Windows.of(window, slide, start_offset)
    end = F.col("window.end")
    return with_window(messages, layout, ts).select(
        "topic",
        F.date_format(end, "yyyy-MM-dd").alias("dt"),
        epoch_millis(end, is_ntz(messages, ts)).alias("window_end_ms"),
        "partition",
        "offset",
        shown(F.col("value")).alias("value"),
    )


def archive_path(root: str = "") -> Column:
    """The historic folder of an archived row: ``root/topic/yyyy/MM/dd/ms``."""
    place = F.concat_ws(
        "/", F.col("topic"), F.translate(F.col("dt"), "-", "/"), F.col("window_end_ms").cast("string")
    )
    return F.concat(F.lit(root.rstrip("/") + "/"), place) if root else place


def archive_paths(archived: DataFrame, root: str = "") -> DataFrame:
    """The folders an archive fills, with the number of messages in each."""
    return archived.groupBy(archive_path(root).alias("path")).agg(F.count("*").alias("n"))
