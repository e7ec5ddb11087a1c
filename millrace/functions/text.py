"""Text expressions: space-separated tokens, rendered events and pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(value: Column) -> Column:
    """Split at every single space; empty tokens stay, except at the end.

    The empty text is one empty token and a text of spaces alone has none.
    """
    kept = F.rtrim(value)
    return (
        F.when(value == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, " ", -1))
    )


def shown(value: Column) -> Column:
    """A value inside concatenated text, where a missing one reads ``null``."""
    return F.coalesce(value, F.lit("null"))


def pair(key: Column, value: Column) -> Column:
    """``(key,value)``."""
    return F.concat(F.lit("("), shown(key), F.lit(","), shown(value), F.lit(")"))


# The fields of a rendered event, in this order; e-mail and timestamp are left out.
RENDERED = ("eid", "sessionId", "name", "type", "userId")


def render_event(compat: bool = False) -> Column:
    """An event as one line of JSON.

    ``compat`` gives the historic text, which quotes everything, missing values
    too, and escapes nothing; the default is valid JSON with real nulls.
    """
    if not compat:
        return F.to_json(F.struct(*RENDERED), {"ignoreNullFields": "false"})
    pieces = []
    for i, name in enumerate(RENDERED):
        pieces += [F.lit(("{" if i == 0 else ",") + f'"{name}":"'), shown(F.col(name)), F.lit('"')]
    return F.concat(*pieces, F.lit("}"))
