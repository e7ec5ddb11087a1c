"""Sums over windows that move in small steps, by what enters and what leaves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.durations import epoch_micros, floor_div, from_micros, is_ntz
from millrace.operators.windows import Windows

# Windows of a block of running sums: a day of starts every second.
BLOCK_WINDOWS = 86_400


def window_runs(
    df: DataFrame,
    window: str | int | timedelta,
    slide: str | int | timedelta,
    sums: Mapping[str, str],
    *,
    by: Sequence[str] = (),
    ts: str = "timestamp",
    start_offset: str | int | timedelta = 0,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Count and sums per window, as runs of windows that hold the same rows.

    ``sums`` maps a result column to the column added up. A row of the result stands for
    the windows that start from ``first_start`` to ``last_start``, ``windows`` of them, with
    ``count`` and the sums of each; ``each_window`` makes them single. Windows without rows
    have none. A null adds nothing but is counted; rows without a time are in no window.

    Each row counts where it enters and, with the opposite sign, where it has left, so a
    window of a day every second costs two rows an input row, not 86,400. Changes at the same
    start are added up before and in the first shuffle; the second brings blocks of
    ``block_windows`` starts together for their running sums, and only one row per block is
    summed along a key, so a busy key is spread over its blocks. Because sums are taken away
    again, only whole numbers and decimals can be added: they are exact.
    """
    layout = Windows.of(window, slide, start_offset)
    if layout.sampled:
        raise ValueError("windows that leave out rows have nothing in common; use window_counts")
    for name in sums.values():
        if not isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType)):
            raise TypeError(f"{name} is {df.schema[name].dataType.simpleString()}; only exact numbers can be taken away again")
    ntz = is_ntz(df, ts)
    timed = df.where(F.col(ts).isNotNull()).withColumn("_micros", epoch_micros(F.col(ts), ntz) - layout.offset)
    values = {"count": F.lit(1).cast("bigint"), **{name: F.col(c) for name, c in sums.items()}}

    def change(at: Column, sign: int) -> Column:
        return F.struct(at.alias("at"), *[(v * sign).alias(name) for name, v in values.items()])

    enters = floor_div(F.col("_micros") - layout.window, layout.slide) + 1
    leaves = floor_div(F.col("_micros"), layout.slide) + 1
    changes = timed.select(*by, F.explode(F.array(change(enters, 1), change(leaves, -1))).alias("_c")).select(*by, "_c.*")
    blocked = changes.withColumn("_block", floor_div(F.col("at"), block_windows))
    keys = [*by, "_block"]
    summed = blocked.groupBy(*keys, "at").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in values])
    along = Window.partitionBy(*keys).orderBy("at")
    inner = summed.select(
        *keys, "at", F.lead("at").over(along).alias("_next"),
        *[F.sum(n).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(n) for n in values],
    )
    blocks = summed.groupBy(*keys).agg(F.min("at").alias("_first"), *[F.sum(n).alias(n) for n in values])
    over = Window.partitionBy(*by).orderBy("_block")
    before = blocks.select(
        *[F.col(c).alias(f"_of{c}") for c in keys],
        F.lead("_first").over(over).alias("_following"),
        *[F.coalesce(F.sum(n).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_before_{n}") for n in values],
    )
    here = F.col("_block") == F.col("_of_block")
    for name in by:
        here = here & F.col(name).eqNullSafe(F.col(f"_of{name}"))
    whole = inner.join(before, here).select(
        *by, "at", F.coalesce("_next", "_following").alias("_until"),
        *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in values],
    )
    start = lambda k: from_micros(k * layout.slide + layout.offset, ntz)
    return whole.where(F.col("count") > 0).select(
        *by,
        start(F.col("at")).alias("first_start"),
        start(F.col("_until") - 1).alias("last_start"),
        (F.col("_until") - F.col("at")).alias("windows"),
        *values,
    )


def each_window(runs: DataFrame, window: str | int | timedelta, slide: str | int | timedelta) -> DataFrame:
    """Runs as single windows: ``window_start`` and ``window_end`` in place of the run's bounds."""
    layout = Windows.of(window, slide)
    ntz = is_ntz(runs, "first_start")
    single = runs.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("windows") - 1)))
    start = epoch_micros(F.col("first_start"), ntz) + F.col("_k") * layout.slide
    rest = [c for c in runs.columns if c not in ("first_start", "last_start", "windows")]
    return single.select(
        *rest, from_micros(start, ntz).alias("window_start"), from_micros(start + layout.window, ntz).alias("window_end")
    )
