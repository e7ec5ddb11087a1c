"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from millrace.operators import archive, events, windows
from millrace.plans.catalog import CATALOG, sample
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"
BATCH = [n for n in CATALOG if not n.endswith("_stream") and n not in (
    "events_parquet_roundtrip", "stream_equals_batch", "restart_no_duplicates")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join(spark, name):
    text = plan(CATALOG[name](spark, SF))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert word not in text


@pytest.mark.parametrize("name", ["event_projection", "event_type_tag", "archive_rows", "bulk_documents", "raw_dump",
                                  "event_quarantine", "event_render", "topic_subset"])
def test_narrow(spark, name):
    assert "Exchange" not in plan(CATALOG[name](spark, SF))


def test_message_is_parsed_once(spark):
    for df in (events.to_events(sample(spark, SF)), events.quarantine(sample(spark, SF))):
        # one parse of every message, one conditional second look
        assert plan(df).count("from_json(") == 2


def test_counts_read_only_the_time(spark):
    text = plan(windows.window_counts(sample(spark, SF), "10 seconds", "4 seconds"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_overlapping_windows_are_counted_before_they_are_repeated(spark):
    text = plan(windows.window_counts(sample(spark, SF), "10 hours", "4 hours"))
    repeated = text.index("Generate explode")
    assert text.index("partial_count", repeated) > repeated and "Expand" not in text
    assert len(re.findall("Exchange hashpartitioning", text)) == 2
    tumbling = plan(windows.window_counts(sample(spark, SF), "10 hours"))
    assert len(re.findall("Exchange hashpartitioning", tumbling)) == 1


@pytest.mark.parametrize("build", [lambda m, w, s: windows.window_counts(m, w, s), lambda m, w, s: archive.window_archive(m, w, s)])
def test_overlapping_windows_are_generated_code_of_one_size(spark, build):
    few, many = (plan(build(sample(spark, SF), *layout)) for layout in (("10 seconds", "4 seconds"), ("1 day", "1 second")))
    assert "transform(" not in many and "lambda" not in many
    assert len(many) < 1.05 * len(few)
    assert "Generate explode(sequence(" in many


def test_filling_gaps_reads_the_input_once(spark):
    counted = windows.window_counts(
        events.to_events(sample(spark, SF)), "10 minutes", "4 minutes", ts="arrived", kinds=windows.COUNT_KINDS, dense=True
    )
    counted.collect()
    final = plan(counted).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_concatenation_never_groups_texts_by_window_alone(spark):
    text = plan(archive.window_concat(sample(spark, SF), "1 day"))
    assert text.count("FileScan") == 1
    (exchange,) = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert re.search(r"segment#\d+", exchange)
