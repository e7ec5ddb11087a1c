"""Durations, and time arithmetic that is exact for both timestamp types."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def to_micros(duration: str | int | timedelta) -> int:
    """``'10 seconds'``, a ``timedelta`` or a whole number of seconds, in microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    if isinstance(duration, int):
        return duration * _UNIT_MICROS["second"]
    parts = re.findall(r"(-?\d+)\s*([a-z]+?)s?(?=[\s\d-]|$)", duration.strip().lower())
    if not parts or any(unit not in _UNIT_MICROS for _, unit in parts):
        raise ValueError(f"not a duration: {duration!r}")
    return sum(int(number) * _UNIT_MICROS[unit] for number, unit in parts)


def floor_div(number: Column, by: int) -> Column:
    """``number`` divided and rounded down, in whole numbers, so that no large one is off by rounding."""
    return F.call_function("div", number - F.pmod(number, F.lit(by)), F.lit(by))


def is_ntz(df: DataFrame, column: str) -> bool:
    """Whether ``column`` is a wall-clock timestamp; anything but a timestamp is an error."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        raise TypeError(f"{column} is {kind.simpleString()}, not a timestamp")
    return isinstance(kind, T.TimestampNTZType)


def shift(ts: Column, micros: int | Column, ntz: bool) -> Column:
    """``ts`` moved by an exact number of microseconds.

    A TIMESTAMP plus a day-time interval follows the session zone's clock
    changes, so zoned values go through epoch microseconds instead.
    """
    if ntz:
        step = timedelta(microseconds=micros) if isinstance(micros, int) else None
        interval = F.lit(step) if step is not None else F.lit(timedelta(microseconds=1)) * micros
        return ts + interval
    return F.timestamp_micros(F.unix_micros(ts) + micros)


def _wall_clock_epoch(ts: Column, per_second: int) -> Column:
    """Time since 1970 of a wall-clock timestamp read as UTC, rounded down to the unit."""
    since = ts - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

    def part(field: str, seconds: int) -> Column:
        return F.extract(F.lit(field), since) * F.lit(seconds * per_second).cast("bigint")

    return (
        part("DAY", 86_400) + part("HOUR", 3_600) + part("MINUTE", 60) + F.floor(part("SECOND", 1)).cast("bigint")
    )


def epoch_micros(ts: Column, ntz: bool) -> Column:
    """Microseconds since 1970, reading a wall-clock timestamp as UTC in any session zone."""
    return _wall_clock_epoch(ts, 1_000_000) if ntz else F.unix_micros(ts)


def from_micros(micros: Column, ntz: bool) -> Column:
    """The reverse of ``epoch_micros``."""
    return shift(F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), micros, True) if ntz else F.timestamp_micros(micros)


def epoch_millis(ts: Column, ntz: bool) -> Column:
    """Milliseconds since 1970, rounded down: the number that names an archive folder."""
    return _wall_clock_epoch(ts, 1_000) if ntz else F.unix_millis(ts)
