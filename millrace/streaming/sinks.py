"""What a stream does with each micro-batch.

A sink is a function of (batch, batch_id). Whatever it writes goes to a folder of
that batch, replaced as a whole, so a batch that is run again leaves the same
files.

Rows are written by the tasks that read them unless ``rows_per_file`` is given. A
Kafka task holds one topic and a short time, so that needs no shuffle. Files that
mix topics and dates would leave a small file per task and folder: then the rows
of a folder are first gathered, at most ``rows_per_file`` neighbouring offsets of a
partition together, so that a folder with a third of all rows has many writers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import pair
from millrace.operators.archive import ARCHIVE_COLUMNS, SEPARATOR, window_archive
from millrace.operators.documents import bulk_lines, event_documents, event_place
from millrace.operators.events import EVENT_COLUMNS, classify, events_of, rejects_of
from millrace.operators.windows import untimed
from millrace.sources.offsets import write_ledger

Sink = Callable[[DataFrame, int], None]

# How the search job talks to its cluster; nodes and port are the
# caller's. The last two make the column `place` the document id.
CONNECTOR_OPTIONS = {
    "es.index.auto.create": "true",
    "es.http.timeout": "5m",
    "es.scroll.size": "50",
    "es.mapping.id": "place",
    "es.mapping.exclude": "place",
}

ARCHIVE_SCHEMA = (
    "partition int, offset bigint, value string, topic string, dt string, window_end_ms bigint, batch_id bigint"
)
EVENT_SCHEMA = ", ".join(f"`{c}` string" for c in EVENT_COLUMNS) + ", topic string, dt string, batch_id bigint"
REJECT_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, "
    "reason string, batch_id bigint"
)


def replace_batch(
    rows: DataFrame, batch_id: int, path: str, partitions: Sequence[str] = (), fmt: str = "parquet", **options: str
) -> None:
    """Write one batch below ``path``, replacing what an earlier try of it left.

    ``batch_id`` is the last folder level: several batches share a window or a
    date, and replacing that folder would remove the rows of the others.
    """
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*partitions, "batch_id")
        .save(path)
    )


def _gathered(rows: DataFrame, folders: Sequence[str], rows_per_file: int | None) -> DataFrame:
    if rows_per_file is None:
        return rows
    return rows.repartition(*folders, "partition", F.call_function("div", F.col("offset"), F.lit(rows_per_file)))


def _bounded(rows_per_file: int | None) -> dict[str, str]:
    """Gathering sends rows together but bounds no file, as hash partitions merge; this option does."""
    return {} if rows_per_file is None else {"maxRecordsPerFile": str(rows_per_file)}


def skip_empty(sink: Sink) -> Sink:
    """``sink`` for batches with rows; an empty one leaves no folder behind."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            sink(batch, batch_id)

    return run


def fan_out(*sinks: Sink) -> Sink:
    """Several sinks over one read of the batch, in the given order."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                for sink in sinks:
                    sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def archive_sink(
    root: str,
    window: str | int,
    slide: str | int | None = None,
    *,
    fmt: str = "parquet",
    separator: str = SEPARATOR,
    rows_per_file: int | None = None,
    rejects: str | None = None,
) -> Sink:
    """Messages by topic, date, window end and batch.

    Messages without a time are in no window; given ``rejects`` they are kept there, whole.

    ``parquet`` keeps the window end as a sorted column: a folder for each window
    would be millions of small ones. ``text`` is the historic layout, a folder for
    each window with the messages of a file joined by ``separator``.
    """
    if fmt not in ("parquet", "text"):
        raise ValueError(f"an archive is parquet or text, not {fmt!r}")

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = window_archive(batch, window, slide)
        order = ["topic", "dt", "window_end_ms", "partition", "offset"]
        if fmt == "text":
            folders = ["topic", "dt", "window_end_ms"]
            lines = _gathered(rows, folders, rows_per_file).sortWithinPartitions(*order).select(*folders, "value")
            replace_batch(lines, batch_id, root, folders, "text", lineSep=separator, **_bounded(rows_per_file))
        else:
            rows = _gathered(rows, ["topic", "dt"], rows_per_file).sortWithinPartitions(*order)
            replace_batch(rows, batch_id, root, ["topic", "dt"], **_bounded(rows_per_file))
        if rejects:
            left = untimed(batch)
            replace_batch(left.withColumn("timestamp", F.col("timestamp").cast("timestamp")), batch_id, rejects)

    return skip_empty(run)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The archived rows of a parquet archive."""
    return spark.read.schema(ARCHIVE_SCHEMA).parquet(root).select(*ARCHIVE_COLUMNS, "batch_id")


def read_text_archive(spark: SparkSession, root: str, separator: str = SEPARATOR) -> DataFrame:
    """The archived messages of a text archive, with their folders as columns."""
    schema = "value string, topic string, dt string, window_end_ms bigint, batch_id bigint"
    return spark.read.schema(schema).option("lineSep", separator).format("text").load(root)


def events_sink(
    root: str,
    rejects: str | None = None,
    *,
    sid_path: str = "passport.sid",
    view: str | None = "events",
    on_view: Sink | None = None,
    rows_per_file: int | None = None,
) -> Sink:
    """Event rows by topic, date and batch, and the messages that are none to ``rejects``.

    The batch's events are registered as ``view`` first; ``on_view`` may query it
    through the batch's own session.
    """
    folders = ["topic", "dt"]

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = classify(batch, sid_path)
        reread = rejects is not None or on_view is not None
        if reread:
            parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = events_of(parsed)
            if view:
                events.createOrReplaceTempView(view)
            if on_view:
                on_view(events, batch_id)
            dated = events.withColumn("dt", F.date_format("arrived", "yyyy-MM-dd"))
            replace_batch(
                _gathered(dated, folders, rows_per_file).select(*EVENT_COLUMNS, *folders), batch_id, root, folders
            )
            if rejects:
                replace_batch(rejects_of(parsed), batch_id, rejects)
        finally:
            if reread:
                parsed.unpersist()

    return skip_empty(run)


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """The stored event rows, with topic, date and batch."""
    return spark.read.schema(EVENT_SCHEMA).parquet(root)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The stored messages that are no events."""
    return spark.read.schema(REJECT_SCHEMA).parquet(path)


def bulk_sink(path: str, resource: str, *, sid_path: str = "passport.sid") -> Sink:
    """One document per event, as files of bulk request lines for a loader."""

    def run(batch: DataFrame, batch_id: int) -> None:
        events = events_of(classify(batch, sid_path))
        replace_batch(bulk_lines(event_documents(events, resource)), batch_id, path, fmt="text")

    return skip_empty(run)


def connector_sink(
    resource: str, options: dict[str, str], *, fmt: str = "org.elasticsearch.spark.sql", sid_path: str = "passport.sid"
) -> Sink:
    """Event rows straight to an index through a connector on the class path.

    The message's place is the document id, not a field, so a batch that is run
    again replaces its documents.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        events = events_of(classify(batch, sid_path))
        rows = events.select(*EVENT_COLUMNS, event_place().alias("place"))
        rows.write.format(fmt).options(**{**CONNECTOR_OPTIONS, **options}).mode("append").save(resource)

    return skip_empty(run)


def dump_sink(path: str) -> Sink:
    """Every message as a ``(key,value)`` line."""

    def run(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch.select(pair(F.col("key"), F.col("value")).alias("value")), batch_id, path, fmt="text")

    return skip_empty(run)


def ledger_sink(path: str, islands: bool = False) -> Sink:
    """The offsets the batch covered, as ranges or as stretches without gaps. Put it last, after the data."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_ledger(batch, batch_id, path, islands)

    return skip_empty(run)


def updates_sink(path: str) -> Sink:
    """The rows an update-mode query changed, a folder per batch; ``read_updates`` has the newest of each key.

    A batch writes what it touched, not the whole result as a snapshot does.
    """

    def run(changed: DataFrame, batch_id: int) -> None:
        replace_batch(changed, batch_id, path)

    return run


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key, combined before the shuffle."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_newest"))
    return newest.select(*keys, *[F.col(f"_newest.`{c}`").alias(c) for c in values])


def snapshot_sink(path: str) -> Sink:
    """The whole result of a complete-mode query, after each batch.

    Two folders take turns, so the last finished snapshot stays whole while the
    next one is being written. A note beside each, written after it, says that it
    is finished.
    """

    def run(result: DataFrame, batch_id: int) -> None:
        slot = batch_id % 2
        stamped = result.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        stamped.write.mode("overwrite").parquet(f"{path}/data/slot={slot}")
        note = result.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
        note.write.mode("overwrite").parquet(f"{path}/finished/slot={slot}")

    return run


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished snapshot; one that is only half written is not read."""
    notes = spark.read.schema("batch_id bigint, slot int").parquet(f"{path}/finished")
    newest = notes.agg(F.max("batch_id")).first()[0]
    if newest is None:
        raise ValueError(f"no finished snapshot below {path}")
    rows = spark.read.parquet(f"{path}/data/slot={newest % 2}")
    return rows.where(F.col("batch_id") == F.lit(newest)).drop("batch_id")
