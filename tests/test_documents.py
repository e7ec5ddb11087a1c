"""Search documents and raw lines."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from millrace.functions.text import pair
from millrace.operators.documents import bulk_lines, event_documents, event_place, to_bulk_documents
from millrace.operators.events import to_events


def test_rows(spark):
    df = spark.createDataFrame([(1, 'a "q"\n', None)], "id int, t string, n string")
    row = to_bulk_documents(df, "idx", "id").first()
    assert json.loads(row["action"]) == {"index": {"_index": "idx", "_id": "1"}}
    assert json.loads(row["source"]) == {"id": 1, "t": 'a "q"\n'}
    full = to_bulk_documents(df, "idx", columns=["t", "n"], ignore_nulls=False).first()
    assert json.loads(full["action"]) == {"index": {"_index": "idx"}}
    assert json.loads(full["source"]) == {"t": 'a "q"\n', "n": None}


def test_maps_of_different_keys(spark):
    df = spark.createDataFrame([({"one": "1", "two": "2"},), ({"OTP": "Otopeni"},)], "doc map<string,string>")
    out = to_bulk_documents(df, "spark/docs").collect()
    assert [json.loads(r["source"]) for r in out] == [{"one": "1", "two": "2"}, {"OTP": "Otopeni"}]
    assert json.loads(out[0]["action"]) == {"index": {"_index": "spark", "_type": "docs"}}


def test_event_documents_have_a_stable_id(make_messages):
    messages = make_messages([("RawEvents", 2, 17, 0, '{"eid":"x"}')])
    documents = event_documents(to_events(messages), "events")
    assert json.loads(documents.first()["action"])["index"]["_id"] == "RawEvents-2-17"
    assert bulk_lines(documents).first()["value"].count("\n") == 1


def test_pairs(spark):
    df = spark.createDataFrame([(None, "v"), ("k", None)], "key string, value string")
    assert [r[0] for r in df.select(pair(F.col("key"), F.col("value"))).collect()] == ["(null,v)", "(k,null)"]


def test_null_map_and_null_place(spark):
    rows = spark.sql("SELECT map('a', 1) AS m UNION ALL SELECT NULL")
    assert sorted(r["source"] for r in to_bulk_documents(rows, "i").collect()) == ['{"a":1}', "{}"]
    places = spark.sql("SELECT 't' AS topic, CAST(NULL AS INT) AS partition, 5L AS offset").select(event_place().alias("p"))
    assert places.first()["p"] == "t-null-5"
