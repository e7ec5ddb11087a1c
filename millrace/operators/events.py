"""Messages to events: projection, quarantine, type tags, rendering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import payload
from millrace.functions.text import render_event as render_expression

# The event row, in its stored column order. All seven are strings; e-mail, name
# and timestamp belong to the row but no message fills them.
EVENT_COLUMNS = ("eid", "email", "name", "sessionId", "timestamp", "type", "userId")

# Where an event came from. Arrival time is renamed: an event has its own `timestamp`.
LINEAGE = ("topic", "partition", "offset", "arrived")

# The type given to the events of each topic.
TOPIC_TYPES = {"RawEvents": "rawEvent", "PassportEvents": "passportEvent", "SessionsRes": "sessionRes"}


def classify(messages: DataFrame, sid_path: str = "passport.sid") -> DataFrame:
    """Each message with its parsed ``fields`` and a quarantine ``reason``, null for an event.

    The reason goes through ``explode`` of a one-element array: a later filter on
    it then stays above the parse instead of being rewritten into a second copy of
    it. The fields stay variants until a column is asked for.
    """
    path = payload.SessionPath.of(sid_path)
    value = F.col("value")
    parsed = messages.withColumn("_sealed", payload.parse(value, path))
    parsed = parsed.withColumn("_doc", payload.opened(F.col("_sealed"), value))
    if path.parent is None:
        parsed = parsed.withColumn("fields", payload.flat_fields(F.col("_doc"), path))
    else:
        parsed = parsed.withColumn("_sealed", payload.parse_again(value, F.col("_doc"), path))
        again = payload.opened(F.col("_sealed"), value)
        parsed = parsed.withColumn("_again", again).withColumn(
            "fields", payload.nested_fields(F.col("_doc"), F.col("_again"), path)
        )
    why = payload.reason(value, F.col("fields"), path)
    return parsed.select(*messages.columns, "fields", F.explode(F.array(why)).alias("reason"))


def events_of(classified: DataFrame, event_type: str | None = None, lineage: bool = True) -> DataFrame:
    """The event rows of classified messages."""
    columns = {name: F.lit(None).cast("string") for name in EVENT_COLUMNS}
    columns.update(payload.texts(F.col("fields")), type=F.lit(event_type).cast("string"))
    source = [F.col("topic"), F.col("partition"), F.col("offset"), F.col("timestamp").alias("arrived")]
    return classified.where(F.col("reason").isNull()).select(
        *(source if lineage else []), *[column.alias(name) for name, column in columns.items()]
    )


def rejects_of(classified: DataFrame) -> DataFrame:
    """The classified messages that are no events, each whole and with its reason."""
    return classified.where(F.col("reason").isNotNull()).drop("fields")


def to_events(
    messages: DataFrame,
    sid_path: str = "passport.sid",
    event_type: str | None = None,
    lineage: bool = True,
) -> DataFrame:
    """JSON messages to event rows. ``sid_path='sid'`` reads the flat form."""
    return events_of(classify(messages, sid_path), event_type, lineage)


def quarantine(messages: DataFrame, sid_path: str = "passport.sid") -> DataFrame:
    """The messages ``to_events`` leaves out, with the reason."""
    return rejects_of(classify(messages, sid_path))


def tag_type(events: DataFrame, types: Mapping[str, str] = TOPIC_TYPES) -> DataFrame:
    """``type`` set by topic; topics without an entry keep theirs."""
    tag = F.col("type")
    for topic, name in types.items():
        tag = F.when(F.col("topic") == topic, name).otherwise(tag)
    return events.withColumn("type", tag)


def of_kind(events: DataFrame, kinds: str | Sequence[str]) -> DataFrame:
    """Events of one kind or several; an event without a kind is not one of them."""
    return events.where(F.col("eid").isin([kinds] if isinstance(kinds, str) else list(kinds)))


def render_event(events: DataFrame, compat: bool = False, column: str = "line") -> DataFrame:
    """Each event with its one-line text form."""
    return events.withColumn(column, render_expression(compat))
