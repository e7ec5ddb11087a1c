"""Operators with state of their own: zero windows while a stream runs, and running values per key.

Both are ``transformWithState`` processors, which are called where no row arrives as
well, by timers of event time. Each sees little: window counts come ready from Spark's
own aggregation, and a busy key is dealt over several places.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import epoch_micros, from_micros, is_ntz, to_micros
from millrace.operators.windows import COUNT_SLIDE, COUNT_WINDOW, Windows, window_counts

# The group of counts that are not by anything.
_ALL = "_all"


class _Gaps(StatefulProcessor):
    """Final window counts of one group, with zeros in between, up to the watermark.

    The state is the start of the next window. Rows of a batch lie between the last
    watermark and this one, so what a batch brings goes on from what was given out.
    """

    def __init__(self, layout: Windows, columns: Sequence[str], counts: int, idle: int | None):
        self.window, self.slide, self.idle = layout.window, layout.slide, idle
        self.row, self.none = Row(*columns), (0,) * counts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("next", "start bigint, seen bigint")

    def _given(self, key: tuple, found: dict[int, tuple], watermark_ms: int) -> Iterator[Row]:
        start, seen = self.state.get() if self.state.exists() else (None, None)
        if found:
            start = min(found) if start is None else min(start, min(found))
            seen = max(found) if seen is None else max(seen, max(found))
        if start is None:
            return
        closed = watermark_ms * 1_000 - self.window
        quiet = None if self.idle is None else seen + self.idle
        last = max(closed, max(found, default=closed)) if quiet is None else max(min(closed, quiet), max(found, default=start - 1))
        while start <= last:
            yield self.row(*key, start, *found.get(start, self.none))
            start += self.slide
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
        if quiet is not None and start > quiet:
            self.state.clear()  # comes back with its next row, at that row's window
            return
        self.state.update((start, seen))
        self.handle.registerTimer(max(-(-(start + self.window) // 1_000), watermark_ms + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = {row["_start"]: tuple(row)[len(key) + 1 :] for row in rows}
        yield from self._given(key, found, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._given(key, {}, timerValues.getCurrentWatermarkInMs())


def dense_window_counts(
    df: DataFrame,
    window: str | int | timedelta = COUNT_WINDOW,
    slide: str | int | timedelta | None = COUNT_SLIDE,
    *,
    ts: str = "timestamp",
    by: Sequence[str] = (),
    kinds: Mapping[str, str] | None = None,
    kind_column: str = "eid",
    start_offset: str | int | timedelta = 0,
    idle: str | int | timedelta | None = None,
) -> DataFrame:
    """Rows per window of a stream, windows without rows included, each once it is closed.

    ``window_counts(dense=True)`` for a stream with a watermark on ``ts``, in append
    mode. A window without rows is given out when the watermark passes its end,
    whether or not its group had a row in that batch; this goes on for as long as
    the stream runs, or, with ``idle``, for that long after a group's last row, whose
    state then goes until its next row.

    Spark counts first, combined before the shuffle, so a group's state sees one row
    per window, however busy the group is.
    """
    if not df.isStreaming:
        raise ValueError("for a table use window_counts(dense=True)")
    layout = Windows.of(window, slide, start_offset)
    quiet = None if idle is None else to_micros(idle)
    counted = window_counts(df, window, slide, ts=ts, by=by, kinds=kinds, kind_column=kind_column, start_offset=start_offset)
    counts = ["count", *(kinds or {})]
    groups = [F.col(name) for name in by] or [F.lit(0).alias(_ALL)]
    narrow = counted.select(*groups, F.unix_micros("window_start").alias("_start"), *counts)
    keys = list(by) or [_ALL]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.select(*keys).schema)
    schema = f"{kept}, _start bigint, " + ", ".join(f"`{name}` bigint" for name in counts)
    processor = _Gaps(layout, [*keys, "_start", *counts], len(counts), quiet)
    dense = narrow.groupBy(*keys).transformWithState(processor, schema, "Append", "EventTime")
    span = [from_micros(F.col("_start") + extra, False) for extra in (0, layout.window)]
    return dense.select(*by, span[0].alias("window_start"), span[1].alias("window_end"), *counts)


class _Running(StatefulProcessor):
    """Count, first and last of one key in one place; the order is (time, place), whatever the order of arrival."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("running", "n bigint, fa bigint, fp string, f string, la bigint, lp string, l string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            self._keep(self._added(row.n, (row.fa, row.fp, row.f), (row.la, row.lp, row.l)), timerValues)

    def _added(self, n, first, last) -> tuple:
        if self.state.exists():
            known = self.state.get()
            n += known[0]
            first, last = min(first, known[1:4], key=lambda x: x[:2]), max(last, known[4:7], key=lambda x: x[:2])
        return (int(n), int(first[0]), *first[1:], int(last[0]), *last[1:])

    def _keep(self, state: tuple, timerValues) -> None:
        self.state.update(state)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
            self.handle.registerTimer(max(state[4] // 1_000 + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows come before timers: a state that is due to go is gone for a row of the same batch, too.
        if self.idle_ms is not None and self.state.exists():
            if timerValues.getCurrentWatermarkInMs() >= self.state.get()[4] // 1_000 + self.idle_ms:
                self.state.clear()
        for part in rows:
            part = part.sort_values(["at", "place"])
            first, last = ((r["at"], r["place"], r["value"]) for r in (part.iloc[0], part.iloc[-1]))
            self._keep(self._added(len(part), first, last), timerValues)
        yield pd.DataFrame([(*key, *self.state.get())])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())


def running_values(
    messages: DataFrame,
    key: str,
    value: str,
    *,
    ts: str = "timestamp",
    place: Sequence[str] = ("topic", "partition", "offset"),
    places: int = 16,
    idle: str | int | timedelta | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """How often each key came, and its first and last ``value``, kept as state that each batch updates.

    In update mode: ``key, part, n, fa, fp, f, la, lp, l`` (count; time, place and value of the first
    and the last), one row per part of a key that a batch touched. A key is dealt over ``places`` parts,
    so that one with a third of all messages is no single task; ``whole_keys`` joins them. Times and
    places decide the order, not arrival. A message without a time comes before all others, a null key
    is a key.

    ``initial`` are rows of the same columns from an earlier run. With ``idle`` the state of a part goes
    once the watermark is that far beyond its last message; the stream then needs a watermark.
    """
    at = F.coalesce(epoch_micros(F.col(ts), is_ntz(messages, ts)), F.lit(0))
    spot = F.concat_ws(":", *[F.lpad(F.col(c).cast("string"), 20, "0") if c == "offset" else F.col(c).cast("string") for c in place])
    # Nulls are no keys of the state's own columns; the empty mark cannot be a text, as texts get a letter.
    named = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))
    keep = [ts] if idle is not None else []
    rows = messages.select(
        named.alias("key"), F.pmod(F.xxhash64(*place), F.lit(places)).cast("int").alias("part"), at.alias("at"),
        spot.alias("place"), F.col(value).cast("string").alias("value"), *keep,
    )
    schema = "key string, part int, n bigint, fa bigint, fp string, f string, la bigint, lp string, l string"
    processor = _Running(None if idle is None else to_micros(idle) // 1_000)
    start = None if initial is None else _marked(initial).groupBy("key", "part")
    out = rows.groupBy("key", "part").transformWithStateInPandas(
        processor, schema, "Update", "None" if idle is None else "EventTime", start
    )
    return out.withColumn("key", _unmarked(F.col("key")))


def _marked(df: DataFrame) -> DataFrame:
    return df.withColumn("key", F.coalesce(F.concat(F.lit("k"), F.col("key")), F.lit("")))


def _unmarked(key: Column) -> Column:
    return F.when(key != "", F.substring(key, 2, 2**31 - 1))


def whole_keys(parts: DataFrame) -> DataFrame:
    """One row per key from its parts: ``key, n, first_at, first, last_at, last``."""
    order = lambda at, place: F.struct(F.col(at), F.col(place))
    out = parts.groupBy("key").agg(
        F.sum("n").alias("n"),
        F.min("fa").alias("first_at"),
        F.min_by("f", order("fa", "fp")).alias("first"),
        F.max("la").alias("last_at"),
        F.max_by("l", order("la", "lp")).alias("last"),
    )
    return out.withColumns({name: from_micros(F.col(name), False) for name in ("first_at", "last_at")})
