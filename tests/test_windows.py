"""Windows and counts against brute force."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.durations import epoch_micros, epoch_millis, to_micros
from millrace.operators.windows import Windows, label_counts, window_counts, with_window

EPOCH = datetime(1970, 1, 1)
LAYOUTS = [
    ("30 seconds", None, 0),
    ("10 seconds", "4 seconds", 0),
    ("12 seconds", "4 seconds", 0),
    ("10 seconds", "4 seconds", "3 seconds"),
    ("7 seconds", "3 seconds", "500 milliseconds"),
    ("2 seconds", "6 seconds", 0),
    ("2 seconds", "6 seconds", "1 second"),
]


def brute(times, window, slide, offset):
    """Window start -> rows, for starts at ``offset + k * slide``; sampled windows end there."""
    w, s, o = to_micros(window), to_micros(slide if slide is not None else window), to_micros(offset)
    lead = s - w if s > w else 0
    counts = Counter()
    for t in times:
        us = (t - EPOCH) // timedelta(microseconds=1)
        k = (us - o) // s
        start = o + k * s + lead
        while start + w > us:
            if start <= us:
                counts[start] += 1
            start -= s
    return {EPOCH + timedelta(microseconds=k): n for k, n in counts.items()}


@pytest.fixture(scope="module")
def times():
    rng = random.Random(7)
    exact = [datetime(2024, 1, 1) + timedelta(seconds=s) for s in range(0, 60, 2)]
    return exact + [datetime(2024, 1, 1) + timedelta(microseconds=rng.randrange(90_000_000)) for _ in range(300)]


@pytest.fixture(scope="module")
def wall(spark, times):
    rows = [(t, i % 3) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, g int").persist()


@pytest.mark.parametrize("window,slide,offset", LAYOUTS)
def test_counts(wall, times, window, slide, offset):
    out = window_counts(wall, window, slide, start_offset=offset).collect()
    assert {r["window_start"]: r["count"] for r in out} == brute(times, window, slide, offset)
    length = timedelta(microseconds=to_micros(window))
    assert all(r["window_end"] - r["window_start"] == length for r in out)


@pytest.mark.parametrize("window,slide,offset", LAYOUTS)
def test_row_is_in_each_of_its_windows(wall, times, window, slide, offset):
    layout = Windows.of(window, slide, offset)
    rows = with_window(wall, layout)
    assert rows.count() == sum(brute(times, window, slide, offset).values())
    if layout.sampled:
        return
    outside = (F.col("timestamp") < F.col("window.start")) | (F.col("timestamp") >= F.col("window.end"))
    assert rows.where(outside).count() == 0


def test_zoned_times_in_a_zone_with_clock_changes(spark, utc):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    rng = random.Random(3)
    start = 1_711_756_800  # the day before clocks go forward in 2024
    seconds = [start + rng.randrange(3 * 86_400) for _ in range(400)]
    df = spark.createDataFrame([(s,) for s in seconds], "s long").select(
        F.timestamp_seconds("s").alias("timestamp")
    )
    times = [EPOCH + timedelta(seconds=s) for s in seconds]
    for window, slide in (("2 days", "7 hours"), ("30 hours", "30 hours"), ("5 hours", "26 hours")):
        out = window_counts(df, window, slide, dense=False).select(
            F.unix_seconds("window_start").alias("s"), F.unix_seconds("window_end").alias("e"), "count"
        )
        got = {EPOCH + timedelta(seconds=r["s"]): r["count"] for r in out.collect()}
        assert got == brute(times, window, slide, 0)
        assert all(r["e"] - r["s"] == to_micros(window) // 10**6 for r in out.collect())


def test_wall_clock_epoch_ignores_the_session_zone(spark, utc):
    values = [datetime(2024, 3, 31, 2, 30, 0, 123_456), datetime(1969, 12, 31, 23, 59, 59, 999_500), EPOCH]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    df = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")
    rows = df.select("t", epoch_micros(F.col("t"), True).alias("us"), epoch_millis(F.col("t"), True).alias("ms"))
    for r in rows.collect():
        us = (r["t"] - EPOCH) // timedelta(microseconds=1)
        assert (r["us"], r["ms"]) == (us, us // 1000)


def test_kinds_and_groups(wall, times):
    df = wall.withColumn("eid", F.when(F.col("g") == 0, "a").when(F.col("g") == 1, "b"))
    out = window_counts(df, "10 seconds", "4 seconds", by=["g"], kinds={"n_a": "a", "n_b": "b"}).collect()
    for g in range(3):
        mine = {r["window_start"]: r for r in out if r["g"] == g}
        expected = brute([t for i, t in enumerate(times) if i % 3 == g], "10 seconds", "4 seconds", 0)
        assert {k: r["count"] for k, r in mine.items()} == expected
        assert all(r["n_a"] == (r["count"] if g == 0 else 0) for r in mine.values())
        assert all(r["n_b"] == (r["count"] if g == 1 else 0) for r in mine.values())


@pytest.mark.parametrize("window,slide", [("1 second", None), ("3 seconds", "2 seconds"), ("1 second", "3 seconds")])
def test_dense(spark, window, slide):
    base = datetime(2024, 1, 1)
    times = {0: [base, base + timedelta(seconds=9.5), base + timedelta(seconds=31)], 1: [base + timedelta(seconds=3)]}
    df = spark.createDataFrame([(t, g) for g, ts in times.items() for t in ts], "timestamp timestamp_ntz, g int")
    out = window_counts(df, window, slide, by=["g"], dense=True).collect()
    step = timedelta(microseconds=to_micros(slide or window))
    for g, ts in times.items():
        expected = brute(ts, window, slide, 0)
        got = {r["window_start"]: r["count"] for r in out if r["g"] == g}
        if not expected:
            assert got == {}
            continue
        lo, hi = min(expected), max(expected)
        every = {lo + i * step for i in range((hi - lo) // step + 1)}
        assert set(got) == every
        assert got == {t: expected.get(t, 0) for t in every}


def test_dense_over_several_blocks(spark):
    df = spark.createDataFrame([(0,), (25_000,)], "s int").select(
        (F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval(secs="s")).alias("timestamp")
    )
    out = window_counts(df, "1 second", dense=True)
    assert out.count() == 25_001 and out.select("window_start").distinct().count() == 25_001
    assert out.where("count > 0").count() == 2


def test_dense_with_a_null_group(spark):
    rows = [("a", 0), ("a", 3), (None, 1), (None, 1), (None, 4)]
    df = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({'NULL' if g is None else repr(g)}, timestamp_seconds({s}))" for g, s in rows) + " AS t(g, ts)")
    out = window_counts(df, "1 second", ts="ts", by=["g"], dense=True).collect()
    counts = {g: [r["count"] for r in sorted(out, key=lambda r: r["window_start"]) if r["g"] == g] for g in ("a", None)}
    assert counts == {"a": [1, 0, 0, 1], None: [2, 0, 0, 1]}


def test_sliding_plans_have_one_size(spark):
    df = spark.sql("SELECT timestamp_seconds(id) AS ts FROM range(20)")
    size = lambda window, slide: len(window_counts(df, window, slide, ts="ts")._jdf.queryExecution().optimizedPlan().toString())
    assert size("1 day", "1 second") <= size("10 seconds", "4 seconds") + 100


def test_dense_of_nothing(spark):
    empty = spark.createDataFrame([], "timestamp timestamp_ntz")
    assert window_counts(empty, "1 second", dense=True).count() == 0


def test_labels(wall):
    df = wall.withColumn("eid", F.lit("track_event"))
    kinds = {"upsert_session": "upsert_session", "track_event": "track_event"}
    row = label_counts(window_counts(df, "1 day", kinds=kinds)).first()
    n = wall.count()
    assert row["count"] == f"Total: {n}"
    assert row["upsert_session"] == "Eventos RawEvent: 0"
    assert row["track_event"] == f"Eventos track_device: {n}"


def test_durations():
    assert to_micros("10 seconds") == to_micros(10) == to_micros(timedelta(seconds=10)) == 10_000_000
    assert to_micros("1 minute 30 seconds") == 90_000_000
    assert to_micros("250 milliseconds") == 250_000
    for bad in ("", "ten seconds", "10 parsecs"):
        with pytest.raises(ValueError):
            to_micros(bad)
    with pytest.raises(ValueError):
        Windows.of("0 seconds")


def test_only_timestamps(spark):
    with pytest.raises(TypeError):
        window_counts(spark.createDataFrame([("x",)], "timestamp string"), "1 second")
