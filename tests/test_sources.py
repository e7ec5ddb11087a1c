"""Readers: columns, topic choice, push-down."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from millrace.sources.messages import (
    MESSAGE_COLUMNS,
    TOPICS,
    kafka_messages,
    message_schema,
    messages_from_events,
    stored_messages,
    subscribe,
    topic_list,
    values,
)
from tests.conftest import TESTDATA


def test_topic_lists():
    assert topic_list("a,b,a") == topic_list(["a", "b"]) == ["a", "b"]
    assert len(set(TOPICS)) == 9


def test_stored_messages(spark, make_messages, tmp_path):
    rows = [(t, 0, i, i, f"{t}{i}") for t in ("A", "B", "C") for i in range(4)]
    make_messages(rows, ntz=False).write.parquet(f"{tmp_path}/m")
    out = stored_messages(spark, f"{tmp_path}/m", "A,C")
    assert out.columns == list(MESSAGE_COLUMNS) and out.count() == 8
    plan = values(out)._jdf.queryExecution().executedPlan().toString()
    assert "In(topic, [A,C])" in plan and "ReadSchema: struct<value:string,topic:string>" in plan
    live = stored_messages(spark, f"{tmp_path}/m", streaming=True, max_files_per_trigger=1)
    assert live.isStreaming and live.schema == message_schema()


def test_adapter_offsets_are_unique_and_rise_with_the_event(spark):
    messages = messages_from_events(spark.read.parquet(f"{TESTDATA}/sf0.001/events.parquet"))
    assert messages.columns == list(MESSAGE_COLUMNS)
    assert messages.select("topic", "partition", "offset").distinct().count() == messages.count() == 1_000
    assert "Exchange" not in messages._jdf.queryExecution().executedPlan().toString()
    assert subscribe(messages, TOPICS).count() == 1_000


def test_kafka_needs_its_connector(spark):
    """The connector is not part of this image; the reader must at least ask for it by name."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_messages(spark, "host:9092", starting_offsets='{"a":{"0":1}}', max_offsets_per_trigger=10)
