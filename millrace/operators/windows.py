"""Time windows: tumbling, sliding and sampled, and the counts over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import epoch_micros, floor_div, from_micros, is_ntz, shift, to_micros

# The window and slide of the counts job, the kinds it counts and
# the labels it prints in front of each count.
COUNT_WINDOW, COUNT_SLIDE = "10 seconds", "4 seconds"
COUNT_KINDS = {"upsert_session": "upsert_session", "track_event": "track_event"}
COUNT_LABELS = {
    "count": "Total: ",
    "upsert_session": "Eventos RawEvent: ",
    "track_event": "Eventos track_device: ",
}

# Why a message is in no window.
NO_TIME = "NO_TIME"

# Windows per block when gaps are filled.
_BLOCK = 10_000


@dataclass(frozen=True)
class Windows:
    """A window layout in microseconds.

    Windows start at ``offset + k * slide``, counted from 1970. When the slide is
    longer than the window, each window is the last part of its slide.
    """

    window: int
    slide: int
    offset: int = 0

    @classmethod
    def of(
        cls,
        window: str | int | timedelta,
        slide: str | int | timedelta | None = None,
        start_offset: str | int | timedelta = 0,
    ) -> Windows:
        w = to_micros(window)
        s = w if slide is None else to_micros(slide)
        if w <= 0 or s <= 0:
            raise ValueError("window and slide must be longer than zero")
        return cls(w, s, to_micros(start_offset) % s)

    @property
    def sampled(self) -> bool:
        return self.slide > self.window

    @property
    def sliding(self) -> bool:
        return self.slide < self.window

    def column(self, ts: str | Column) -> Column:
        """Spark's window of a time; for a sampled layout, that of the whole slide."""
        length = self.slide if self.sampled else self.window
        return F.window(ts, f"{length} microseconds", f"{self.slide} microseconds", f"{self.offset} microseconds")

    def bucket(self, ts: str | Column) -> Column:
        """The slide a time falls in."""
        return F.window(ts, f"{self.slide} microseconds", f"{self.slide} microseconds", f"{self.offset} microseconds")


def _in_windows(df: DataFrame, layout: Windows, ts: str, ntz: bool) -> DataFrame:
    """Each row once per window its time falls in, with the column ``window``; a null time falls in none.

    The numbers of the windows are exploded and only then turned into times: a projection of plain
    arithmetic, which is generated code and has one size for any number of windows.
    """
    timed = df.withColumn("_micros", epoch_micros(F.col(ts), ntz) - layout.offset)
    first = floor_div(F.col("_micros") - layout.window, layout.slide) + 1
    numbers = F.sequence(first, floor_div(F.col("_micros"), layout.slide))
    numbered = timed.withColumn("_number", F.explode(numbers))
    start = F.col("_number") * layout.slide + layout.offset
    window = F.struct(from_micros(start, ntz).alias("start"), from_micros(start + layout.window, ntz).alias("end"))
    return numbered.withColumn("window", window).drop("_micros", "_number")


def with_window(df: DataFrame, layout: Windows, ts: str = "timestamp") -> DataFrame:
    """Each row once per window it falls in, with the column ``window``.

    A projection: no shuffle, no state, and it runs on a stream as it is. Rows in
    the gaps of a sampled layout belong to no window and go, and so do rows without
    a time, which ``untimed`` keeps. Overlapping windows of a table are numbered and
    exploded, so the plan has one size for any number of them; a stream keeps
    Spark's own window, which carries the watermark.
    """
    if layout.sliding and not df.isStreaming:
        return _in_windows(df, layout, ts, is_ntz(df, ts))
    rows = df.withColumn("window", layout.column(ts))
    if not layout.sampled:
        return rows
    opens = shift(F.col("window.end"), -layout.window, is_ntz(df, ts))
    return rows.where(F.col(ts) >= opens)


def untimed(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The rows that belong to no window because they have no time, each with its ``reason``.

    What ``with_window`` and everything made of it leaves out for want of a time, so that
    no message goes unseen. A filter on one column: no shuffle, on a table and on a stream.
    """
    return df.where(F.col(ts).isNull()).withColumn("reason", F.lit(NO_TIME))


def bounds(layout: Windows, ntz: bool) -> list[Column]:
    """``window_start`` and ``window_end`` from the column ``window``."""
    end = F.col("window.end")
    start = shift(end, -layout.window, ntz) if layout.sampled else F.col("window.start")
    return [start.alias("window_start"), end.alias("window_end")]


def window_counts(
    df: DataFrame,
    window: str | int | timedelta = COUNT_WINDOW,
    slide: str | int | timedelta | None = None,
    *,
    ts: str = "timestamp",
    by: Sequence[str] = (),
    kinds: Mapping[str, str] | None = None,
    kind_column: str = "eid",
    dense: bool = False,
    start_offset: str | int | timedelta = 0,
) -> DataFrame:
    """Rows per window, in total and for each kind, in one pass.

    ``kinds`` maps a result column to the value counted in it; ``by`` counts each
    group on its own. ``dense`` adds the windows without rows between the first
    and the last of a group, in a batch. On a stream set a watermark on ``ts``
    for append mode; update and complete mode need none.
    """
    layout = Windows.of(window, slide, start_offset)
    ntz = is_ntz(df, ts)
    counts = {"count": F.count("*")}
    for name, value in (kinds or {}).items():
        counts[name] = F.count_if(F.col(kind_column) == value)

    if layout.sliding and not df.isStreaming:
        counted = _shared_panes(df, layout, ts, by, counts, ntz)
    else:
        counted = (
            with_window(df, layout, ts)
            .groupBy(*by, "window")
            .agg(*[total.alias(name) for name, total in counts.items()])
        )
    result = counted.select(*by, *bounds(layout, ntz), *counts)
    if not dense:
        return result
    if df.isStreaming:
        raise ValueError("gaps are filled over a finished table, not on a stream")
    return fill_gaps(result, layout, by=by, counts=tuple(counts))


def _shared_panes(
    df: DataFrame, layout: Windows, ts: str, by: Sequence[str], counts: Mapping[str, Column], ntz: bool
) -> DataFrame:
    """Overlapping windows from counts of the pieces they share.

    Every slide is cut where an earlier window ends in it, so all rows of a piece
    fall in the same windows. The input is counted once into at most two pieces
    per slide; only those counts are repeated for each window. Copying every row
    into each of its windows first would cost ``window / slide`` times as much.
    """
    rest = layout.window % layout.slide
    rows = df.withColumn("_slide", layout.bucket(ts)["start"])
    pane = [*by, "_slide"]
    if rest:
        rows = rows.withColumn("_head", F.col(ts) < shift(F.col("_slide"), rest, ntz))
        pane.append("_head")
    panes = rows.groupBy(*pane).agg(
        F.min(ts).alias("_at"), *[total.alias(name) for name, total in counts.items()]
    )
    windows = _in_windows(panes, layout, "_at", ntz)
    return windows.groupBy(*by, "window").agg(*[F.sum(name).alias(name) for name in counts])


def fill_gaps(
    counted: DataFrame, layout: Windows, *, by: Sequence[str] = (), counts: Sequence[str] = ("count",)
) -> DataFrame:
    """Window counts with a zero row for each missing window of a group.

    The list of windows is built in blocks, first the blocks and then, spread
    over the cluster, the windows of each.
    """
    ntz = is_ntz(counted, "window_start")
    # The totals are not needed, but with them both uses of `counted` read the
    # same columns, so Spark computes it once and reuses the shuffled result.
    totals = [F.sum(name).alias(f"_{name}") for name in counts]
    spans = (
        counted.groupBy(*by)
        .agg(F.min("window_start").alias("_lo"), F.max("window_start").alias("_hi"), *totals)
        .where(F.greatest(*[F.col(f"_{name}") for name in counts], F.lit(0)) >= 0)
        .select(
            *by,
            "_lo",
            F.call_function(
                "div", epoch_micros(F.col("_hi"), ntz) - epoch_micros(F.col("_lo"), ntz), F.lit(layout.slide)
            ).alias("_last"),
        )
        .where(F.col("_last").isNotNull())
    )
    blocks = spans.select(
        *by, "_lo", "_last", F.explode(F.sequence(F.lit(0), F.col("_last"), F.lit(_BLOCK))).alias("_block")
    ).repartition(*by, "_block")
    spine = blocks.select(
        *by,
        "_lo",
        F.explode(
            F.sequence(F.col("_block"), F.least(F.col("_block") + (_BLOCK - 1), F.col("_last")))
        ).alias("_k"),
    ).select(*by, shift(F.col("_lo"), F.col("_k") * layout.slide, ntz).alias("window_start"))
    keys = [*by, "window_start"]
    # Groups may be null, so they meet null-safely.
    found = counted.drop("window_end").withColumnsRenamed({name: f"_found_{name}" for name in by})
    here = F.col("window_start") == F.col("_found_start")
    for name in by:
        here = here & F.col(name).eqNullSafe(F.col(f"_found_{name}"))
    return spine.join(found.withColumnRenamed("window_start", "_found_start"), here, "left").select(
        *keys,
        shift(F.col("window_start"), layout.window, ntz).alias("window_end"),
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in counts],
    )


def label_counts(counted: DataFrame, labels: Mapping[str, str] = COUNT_LABELS) -> DataFrame:
    """Each named count as a line of text, ``label`` then number."""
    lines = {name: F.concat(F.lit(label), F.col(name).cast("string")) for name, label in labels.items()}
    return counted.withColumns(lines)
