"""Offset ranges per topic partition, their text form, and resuming from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.durations import floor_div

# Offsets of a partition that are looked at together for gaps.
BLOCK_OFFSETS = 1_000_000


def offset_ranges(messages: DataFrame) -> DataFrame:
    """First offset, one past the last, and the number of messages, per topic partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count("*").alias("n"),
    )


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges of a topic partition that touch or overlap, made one: ``topic, partition, from_offset, until_offset, n``.

    Ranges of many batches become the islands they cover together; ``n`` is added up.
    """
    place = Window.partitionBy("topic", "partition").orderBy("from_offset", "until_offset")
    reached = F.max("until_offset").over(place.rowsBetween(Window.unboundedPreceding, -1))
    new = (reached.isNull() | (F.col("from_offset") > reached)).cast("int")
    numbered = ranges.withColumn("_new", new).withColumn(
        "_island", F.sum("_new").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy("topic", "partition", "_island").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"), F.sum("n").alias("n")
    ).drop("_island")


def _blocked(messages: DataFrame, block_offsets: int) -> DataFrame:
    block = floor_div(F.col("offset"), block_offsets)
    return messages.where(F.col("offset").isNotNull()).select("topic", "partition", block.alias("_block"), "offset")


def offset_islands(messages: DataFrame, block_offsets: int = BLOCK_OFFSETS) -> DataFrame:
    """The stretches of offsets without a gap: ``topic, partition, from_offset, until_offset, n``.

    Unlike ``offset_ranges`` nothing that is missing lies inside a row. A message that came
    twice counts twice in ``n``; messages without an offset are in no stretch. Null topics and
    partitions are places like others.

    Offsets are looked at in blocks, so a partition with a third of all messages is many
    groups, in one shuffle. Only a stretch that reaches the edge of its block can go on in the
    next, and only those, two a block at most, are put together along a partition.
    """
    along = Window.partitionBy("topic", "partition", "_block").orderBy("offset")
    previous = F.lag("offset").over(along)
    new = (previous.isNull() | (F.col("offset") > previous + 1)).cast("int")
    numbered = _blocked(messages, block_offsets).withColumn("_new", new).withColumn(
        "_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    pieces = numbered.groupBy("topic", "partition", "_block", "_island").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"), F.count("*").alias("n")
    )
    low = F.col("_block") * block_offsets
    at_edge = (F.col("from_offset") == low) | (F.col("until_offset") == low + block_offsets)
    columns = ["topic", "partition", "from_offset", "until_offset", "n"]
    return pieces.where(~at_edge).select(*columns).unionByName(merge_ranges(pieces.where(at_edge).select(*columns)))


def offset_gaps(messages: DataFrame, block_offsets: int = BLOCK_OFFSETS) -> DataFrame:
    """The offsets between a partition's first and last that never came: ``topic, partition, from_offset, until_offset, n``.

    Gaps inside a block are seen there; those between blocks from each block's first and last offset.
    """
    rows = _blocked(messages, block_offsets)
    along = Window.partitionBy("topic", "partition", "_block").orderBy("offset")
    inside = rows.withColumn("_next", F.lead("offset").over(along))
    edges = rows.groupBy("topic", "partition", "_block").agg(F.min("offset").alias("_first"), F.max("offset").alias("offset"))
    next_block = F.lead("_first").over(Window.partitionBy("topic", "partition").orderBy("_block"))
    between = edges.withColumn("_next", next_block)

    def gaps(pairs: DataFrame) -> DataFrame:
        missing: Column = F.col("_next") - F.col("offset") - 1
        return pairs.where(missing > 0).select(
            "topic", "partition", (F.col("offset") + 1).alias("from_offset"), F.col("_next").alias("until_offset"), missing.alias("n")
        )

    return gaps(inside).unionByName(gaps(between))


def safe_offsets(islands: DataFrame) -> DataFrame:
    """Where each partition may go on without skipping what never came: the end of its first stretch."""
    return islands.groupBy("topic", "partition").agg(F.min_by("until_offset", "from_offset").alias("offset"))


def encode_offsets(ranges: DataFrame, column: str = "until_offset") -> DataFrame:
    """One text per topic, ``partition:offset`` joined by commas."""
    entry = F.concat(F.col("partition").cast("string"), F.lit(":"), F.col(column).cast("string"))
    return (
        ranges.withColumn("_entry", entry)
        .groupBy("topic")
        .agg(F.expr("listagg(_entry, ',') WITHIN GROUP (ORDER BY partition)").alias("offsets"))
    )


def decode_offsets(encoded: DataFrame) -> DataFrame:
    """The reverse: one row per topic partition. A null text is a fresh start and has none."""
    return encoded.select(
        "topic", F.explode(F.str_to_map(F.col("offsets"), F.lit(","), F.lit(":"))).alias("partition", "offset")
    ).select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"))


def latest_offsets(ledger: DataFrame) -> DataFrame:
    """Where each topic partition goes on: one past the last offset any batch covered."""
    return ledger.groupBy("topic", "partition").agg(F.max("until_offset").alias("offset"))


def resume_from(messages: DataFrame, points: DataFrame) -> DataFrame:
    """The messages from each partition's resume point on.

    ``points`` has ``topic, partition, offset``. A place listed several times goes
    on from the largest offset, a point without an offset is none, and null topics
    and partitions are places like others. A partition without a point starts
    fresh and keeps everything, and a message without an offset is kept. One lazy
    join: Spark sends small points to all tasks and splits a busy partition.
    """
    known = points.where(F.col("offset").isNotNull()).groupBy(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"))
    known = known.agg(F.max("offset").alias("_from"))
    here = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    later = F.col("_from").isNull() | F.col("offset").isNull() | (F.col("offset") >= F.col("_from"))
    return messages.join(known, here, "left").where(later).select(*messages.columns)
