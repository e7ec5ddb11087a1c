"""Where messages come from: Kafka, stored tables, and the sample event table.

Every reader returns the same six columns, in a batch or a stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The nine topics of the event product (two spelled with one m).
TOPICS = (
    "RawEvents",
    "PassportEvents",
    "SessionsRes",
    "RecommendationReq",
    "RecommendationRes",
    "ContextualizedEvents",
    "ProfiledEvents",
    "RecomendationsRnow",
    "RecomendationsSend",
)

MESSAGE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


def message_schema(ntz: bool = False) -> T.StructType:
    """The message row; ``ntz`` for tables that store wall-clock times."""
    return T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("timestamp", T.TimestampNTZType() if ntz else T.TimestampType()),
        ]
    )


def topic_list(topics: str | Iterable[str]) -> list[str]:
    """Topics from a comma list or a collection, without repeats."""
    names = topics.split(",") if isinstance(topics, str) else topics
    return list(dict.fromkeys(names))


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: str | Iterable[str] = TOPICS,
    *,
    streaming: bool = True,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """All topics in one read, one task per topic partition.

    ``starting_offsets`` is the JSON that ``sources.offsets.starting_offsets``
    builds from a ledger; left out, Spark's default start applies. Needs the
    Kafka connector on the class path.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topic_list(topics)))
    if starting_offsets is not None:
        reader = reader.option("startingOffsets", starting_offsets)
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return (
        reader.options(**(options or {}))
        .load()
        .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", *MESSAGE_COLUMNS[2:])
    )


def stored_messages(
    spark: SparkSession,
    path: str,
    topics: str | Iterable[str] | None = None,
    *,
    streaming: bool = False,
    fmt: str = "parquet",
    ntz: bool = False,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages kept as files; the topic choice reaches the scan as a filter."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(message_schema(ntz))
    if streaming and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    messages = reader.options(**(options or {})).load(path)
    return messages if topics is None else subscribe(messages, topics)


def subscribe(messages: DataFrame, topics: str | Iterable[str]) -> DataFrame:
    """Only the messages of these topics."""
    return messages.where(F.col("topic").isin(topic_list(topics)))


def values(messages: DataFrame) -> DataFrame:
    """The message texts alone."""
    return messages.select(F.col("value").cast("string").alias("value"))


def first_rows(messages: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages by place, for a look at a table; a stream has the console sink.

    Each task keeps its own first ``n``, and only those meet.
    """
    return messages.orderBy("topic", "partition", "offset").limit(n)


def with_event_time(messages: DataFrame, column: str = "timestamp") -> DataFrame:
    """``column`` as a zoned timestamp, which is what a watermark needs."""
    return messages.withColumn(column, F.col(column).cast("timestamp"))


def once(messages: DataFrame, delay: str, *, ts: str = "timestamp", place: Iterable[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Each message once, however often it was delivered.

    A message is its place. On a stream a place is remembered until the watermark, ``delay`` behind the
    latest ``ts``, has passed its message, so a copy that comes within that time goes and state stays
    bounded; one that comes later counts as late. A table needs no delay. Messages without a time or an
    offset cannot be told apart and all stay on a table; on a stream those without a time go, as nothing
    can say when to forget them.
    """
    place = list(place)
    if messages.isStreaming:
        return messages.withWatermark(ts, delay).dropDuplicatesWithinWatermark(place)
    told = F.col("offset").isNotNull()
    return messages.where(told).dropDuplicates(place).unionByName(messages.where(~told))


# What a closing message says: a whole event, so that it goes wherever events go.
CLOSING = '{"eid":"closing","userId":"closing"}'


def closing_messages(spark: SparkSession, at: Column, topics: str | Iterable[str] = TOPICS) -> DataFrame:
    """A message on each topic whose time moves the watermark of a stream that ends.

    Windows close and outer rows come when later messages arrive; after the last one nothing does.
    Spark moves filters on topics and keys below a watermark, so each topic has its own message
    and it is a whole event. ``before`` keeps them out of results.
    """
    topic = F.explode(F.array(*[F.lit(name) for name in topic_list(topics)]))
    values = {"key": F.lit(None).cast("string"), "value": F.lit(CLOSING), "topic": topic}
    place = {"partition": F.lit(0), "offset": F.lit(None).cast("bigint"), "timestamp": at}
    return spark.range(1).select(*[c.alias(name) for name, c in {**values, **place}.items()])


def before(messages: DataFrame, at: Column, ts: str = "timestamp") -> DataFrame:
    """The messages earlier than ``at``. After ``withWatermark`` later ones still move the watermark."""
    return messages.where(F.col(ts) < at)


def messages_from_events(events: DataFrame, dirty: bool = False) -> DataFrame:
    """The sample event table as messages on the nine topics.

    Narrow on purpose: an offset is the event's running number within its topic,
    so it is unique and rising in every topic partition without a sort. The
    ``dirty`` form replaces some texts by ones that cannot become events.
    """
    event_id, user_id = F.col("event_id"), F.col("user_id")
    kind = (
        F.when(F.col("event_type") == "click", "upsert_session")
        .when(F.col("event_type") == "view", "track_event")
        .otherwise(F.col("event_type"))
    )
    passport = (
        F.when(event_id % 5 == 0, "")
        .when(event_id % 7 == 0, ',"passport":{}')
        .otherwise(F.concat(F.lit(',"passport":{"sid":"s'), (user_id % 50).cast("string"), F.lit('"}')))
    )
    user = F.when(event_id % 11 == 0, "").otherwise(
        F.concat(F.lit(',"userId":"u'), user_id.cast("string"), F.lit('"'))
    )
    value = F.concat(F.lit('{"eid":"'), kind, F.lit('"'), passport, user, F.lit("}"))
    if dirty:
        value = (
            F.when(event_id % 101 == 0, "not json")
            .when(event_id % 103 == 0, '{"eid":5}')
            .when(event_id % 107 == 0, '{"passport":null}')
            .otherwise(value)
        )
    topics = F.array(*[F.lit(name) for name in TOPICS])
    return events.select(
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
        F.element_at(topics, (event_id % len(TOPICS) + 1).cast("int")).alias("topic"),
        (user_id % 3).cast("int").alias("partition"),
        F.call_function("div", event_id, F.lit(len(TOPICS))).alias("offset"),
        F.col("ts").alias("timestamp"),
    )
