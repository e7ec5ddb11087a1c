"""The offset ledger: what each batch covered, kept as a table beside the data."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.offsets import offset_islands, offset_ranges

# Fixed value: the offset by which a Kafka read names the beginning of a partition.
EARLIEST = -2

LEDGER_SCHEMA = "topic string, partition int, from_offset bigint, until_offset bigint, n bigint, batch_id bigint"

# Topic partitions that one start option may name by default, far more than a cluster has.
MOST_PARTITIONS = 100_000


def write_ledger(batch: DataFrame, batch_id: int, path: str, islands: bool = False) -> None:
    """Record a batch. Call it after the batch's data is written; a repeat replaces it.

    With ``islands`` a row is a stretch of offsets without a gap, of which a topic partition may have
    several; ``merge_ranges`` of the ledger is then what all batches cover, and nothing that is missing
    is hidden. Without, a row goes from the first offset to the last.
    """
    # One file a batch; the exchange keeps the aggregate itself spread over tasks.
    (
        (offset_islands(batch) if islands else offset_ranges(batch))
        .repartition(1)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All recorded batches."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def starting_offsets(
    points: DataFrame, partition_counts: Mapping[str, int] | None = None, most: int = MOST_PARTITIONS
) -> str | None:
    """The start option of a Kafka read, from ``topic, partition, offset`` rows.

    The option has to name every partition of its topics. ``partition_counts``
    adds those that have no point yet, from their beginning. The option is one
    text on the driver, so more than ``most`` rows are refused, nothing is left out. No rows at all means a fresh start: None, leave the option out.
    """
    rows = points.select("topic", "partition", "offset").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} topic partitions; is this the latest point of each?")
    starts: dict[str, dict[str, int]] = {}
    for topic, partition, offset in sorted(rows):
        starts.setdefault(topic, {})[str(partition)] = offset
    for topic, count in (partition_counts or {}).items():
        for partition in range(count):
            starts.setdefault(topic, {}).setdefault(str(partition), EARLIEST)
    return json.dumps(starts, separators=(",", ":")) if starts else None
