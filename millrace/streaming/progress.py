"""What every batch of every query read and took, as a table: the source's own ranges and rates."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, run string, source string, start_offset string, end_offset string, n bigint, late bigint, "
    "at timestamp, took_ms bigint, rows_per_second double, batch_id bigint"
)


class ProgressLedger(StreamingQueryListener):
    """Writes a row per source and batch to ``path``: where the source began and ended, rows, late rows, delay.

    Offsets are the source's own words, for a Kafka source the JSON of offsets per topic
    partition, which ``kafka_ranges`` reads: unlike the offsets seen in data they hold for empty and
    compacted stretches as well. Add it with ``spark.streams.addListener``. Batches that read nothing
    and dropped nothing leave no row. A batch that is run again by a new run has a row of each.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = progress_rows(json.loads(event.progress.json))
        if rows:
            table = self.spark.createDataFrame(rows, PROGRESS_SCHEMA.replace("at timestamp", "at string"))
            table = table.withColumn("at", F.to_timestamp("at")).coalesce(1)
            table.write.mode("append").partitionBy("batch_id").parquet(self.path)


def progress_rows(progress: dict) -> list[tuple]:
    """One row per source of a batch's progress."""
    late = sum(state.get("numRowsDroppedByWatermark", 0) for state in progress.get("stateOperators", ()))
    if not progress.get("numInputRows") and not late:
        return []
    as_text = lambda offset: None if offset is None else offset if isinstance(offset, str) else json.dumps(offset)
    return [
        (
            progress.get("name") or progress["id"],
            progress["runId"],
            source["description"],
            as_text(source.get("startOffset")),
            as_text(source.get("endOffset")),
            source["numInputRows"],
            late,
            progress["timestamp"],
            progress.get("batchDuration", 0),
            float(source.get("processedRowsPerSecond") or 0),
            progress["batchId"],
        )
        for source in progress["sources"]
    ]


def wait_for_listeners(spark: SparkSession) -> None:
    """Listeners are told in the background; this returns when they have been."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)


def kafka_ranges(progress: DataFrame) -> DataFrame:
    """The ranges a Kafka source reports: ``batch_id, topic, partition, from_offset, until_offset, n``.

    ``n`` is the length of the range, which the topic may not have kept in full. A partition that a
    batch saw first has no beginning there; it starts with its next batch.
    """
    places = "map<string, map<string, bigint>>"
    read = progress.select(
        "batch_id", F.from_json("start_offset", places).alias("_from"), F.explode(F.from_json("end_offset", places)).alias("topic", "_ends")
    )
    each = read.select("batch_id", "topic", F.col("_from")[F.col("topic")].alias("_from"), F.explode("_ends").alias("_partition", "until_offset"))
    ranges = each.select(
        "batch_id",
        "topic",
        F.col("_partition").cast("int").alias("partition"),
        F.col("_from")[F.col("_partition")].alias("from_offset"),
        "until_offset",
    )
    known = ranges.where(F.col("from_offset").isNotNull() & (F.col("from_offset") < F.col("until_offset")))
    return known.withColumn("n", F.col("until_offset") - F.col("from_offset"))
