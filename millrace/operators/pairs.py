"""Two sides of messages or events brought together: answers within a time, and groups of a key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import epoch_micros, floor_div, is_ntz, shift, to_micros

# Offsets of a partition that one row of a group holds.
SEGMENT_ROWS = 1_000


def _later(ts: Column, micros: int, ntz: bool) -> Column:
    """``ts`` plus a fixed span, in the form from which a stream's join reads how long to keep its state."""
    return shift(ts, micros, True) if ntz else ts + F.expr(f"INTERVAL '{micros / 1_000_000:.6f}' SECOND")


def answers(
    requests: DataFrame,
    responses: DataFrame,
    on: str,
    within: str | int | timedelta,
    *,
    how: str = "inner",
    ts: str = "timestamp",
    keep: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """Requests with the responses of the same ``on`` that follow at the same time or up to ``within`` later.

    ``how`` is ``inner`` or ``left``; left keeps the requests without a response, on a
    stream once none can come any more. Rows have ``on`` and, of each side, ``request_``
    and ``response_`` with the columns of ``keep`` and the time ``at``. On streams both
    sides need a watermark on ``ts``; state goes when the interval has passed both.
    A null ``on`` or time is answered by nothing.

    Sides meet by key and slice of time, so one busy key is as many groups as there are
    slices and is never compared with itself as a whole: a request lies in the slice of
    its time, a response in that of its own and in the one before.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"requests are joined inner or left, not {how!r}")
    span = to_micros(within)
    if span <= 0:
        raise ValueError("answers need a time to arrive in")
    ntz = is_ntz(requests, ts)
    if ntz != is_ntz(responses, ts):
        raise TypeError("both sides need the same kind of time")
    slice_of = floor_div(epoch_micros(F.col(ts), ntz), span)
    asked = requests.select(
        F.col(on), slice_of.alias("_slice"), F.col(ts).alias("request_at"), *[F.col(c).alias(f"request_{c}") for c in keep]
    )
    given = responses.select(
        F.col(on).alias("_on"),
        F.explode(F.array(slice_of, slice_of - 1)).alias("_response_slice"),
        F.col(ts).alias("response_at"),
        *[F.col(c).alias(f"response_{c}") for c in keep],
    )
    here = (F.col(on) == F.col("_on")) & (F.col("_slice") == F.col("_response_slice"))
    soon = (F.col("response_at") >= F.col("request_at")) & (F.col("response_at") <= _later(F.col("request_at"), span, ntz))
    columns = [f"{side}_{c}" for side in ("request", "response") for c in ("at", *keep)]
    return asked.join(given, here & soon, how).select(on, *columns)


def cogroup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    value: str = "value",
    *,
    segment_rows: int = SEGMENT_ROWS,
    order: Sequence[str] = ("topic", "partition", "offset"),
) -> DataFrame:
    """Both sides' values of each key, side by side: ``on, segment, n_left, n_right, left_values, right_values``.

    One pass: the sides are stacked and shuffled once. A key comes as one row per
    ``segment_rows`` offsets, so no list grows beyond the partitions' messages in such a
    range, and a key with a third of all rows is spread over as many tasks as it has
    segments; its rows in order are the whole group. Values are in the order of ``order``,
    a null among them stays one. A key that only one side has meets an empty list, a null key
    is a key, and rows without an offset share the segment -1.
    """
    sides = []
    for number, side in enumerate((left, right)):
        segment = F.coalesce(floor_div(F.col("offset"), segment_rows), F.lit(-1).cast("bigint"))
        entry = F.struct(*[F.col(c) for c in order], F.col(value).cast("string").alias("_value"))
        sides.append(side.select(F.col(on), segment.alias("segment"), F.lit(number).alias("_side"), entry.alias("_entry")))
    both = sides[0].unionByName(sides[1]).groupBy(on, "segment")
    lists = [F.array_sort(F.collect_list(F.when(F.col("_side") == n, F.col("_entry")))) for n in (0, 1)]
    grouped = both.agg(lists[0].alias("_left"), lists[1].alias("_right"))
    return grouped.select(
        on,
        "segment",
        F.size("_left").cast("bigint").alias("n_left"),
        F.size("_right").cast("bigint").alias("n_right"),
        F.transform("_left", lambda e: e["_value"]).alias("left_values"),
        F.transform("_right", lambda e: e["_value"]).alias("right_values"),
    )
