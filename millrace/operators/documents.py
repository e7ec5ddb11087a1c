"""Rows as documents for a search index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.events import EVENT_COLUMNS


def _target(resource: str, doc_id: Column | None) -> Column:
    """The action line; ``resource`` is an index, or ``index/type`` for old clusters."""
    index, _, kind = resource.partition("/")
    place = [F.lit(index).alias("_index")]
    if kind:
        place.append(F.lit(kind).alias("_type"))
    if doc_id is not None:
        place.append(doc_id.cast("string").alias("_id"))
    return F.to_json(F.struct(F.struct(*place).alias("index")))


def to_bulk_documents(
    df: DataFrame,
    resource: str,
    id_column: str | Column | None = None,
    columns: Sequence[str] | None = None,
    ignore_nulls: bool = True,
) -> DataFrame:
    """``action`` and ``source``, the two lines of one bulk request entry.

    A document holds ``columns``, or is the map itself if there is just one
    column and it is a map. With an id a repeated write replaces the document
    instead of adding another; without one the index makes it up.
    """
    names = list(columns or df.columns)
    options = {"ignoreNullFields": str(ignore_nulls).lower()}
    one_map = len(names) == 1 and isinstance(df.schema[names[0]].dataType, T.MapType)
    body = F.col(names[0]) if one_map else F.struct(*names)
    doc_id = F.col(id_column) if isinstance(id_column, str) else id_column
    return df.select(_target(resource, doc_id).alias("action"), F.coalesce(F.to_json(body, options), F.lit("{}")).alias("source"))


def event_place() -> Column:
    """``topic-partition-offset``, an id that is the same whenever the message is read; a missing part reads ``null``."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("null")) for name in ("topic", "partition", "offset")]
    return F.concat_ws("-", *parts)


def event_documents(events: DataFrame, resource: str, ignore_nulls: bool = True) -> DataFrame:
    """One document per event, with the message's place as its id."""
    return to_bulk_documents(events, resource, event_place(), EVENT_COLUMNS, ignore_nulls)


def bulk_lines(documents: DataFrame) -> DataFrame:
    """Both lines of each entry in one text column, ready for a text file."""
    return documents.select(F.concat_ws("\n", "action", "source").alias("value"))
