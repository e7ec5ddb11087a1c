"""URL lists: the query against DuckDB, histories against a walk through time, edge cases."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb
import pytest

from millrace.llm import queries
from millrace.llm import url_lists as U

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/pages.parquet'")
    expected = con.execute(f"SELECT page_id, url, lists, allowed, blocked FROM ({queries.SQL['op5_url_lists']})").fetchall()
    rows = [tuple(r) for r in queries.op5_url_lists(spark, path).select("page_id", "url", "lists", "allowed", "blocked").collect()]
    assert sorted(rows) == sorted(expected)
    assert {r[4] for r in rows} == {True, False}


def test_histories_against_a_walk_through_time(spark):
    rng = random.Random(3)
    kinds = [("host", "a.b.org"), ("domain", "b.org"), ("domain", "org"), ("prefix", "a.b.org/x"), ("prefix", "a.b.org/x/y")]
    at = lambda: START + timedelta(days=rng.randrange(40))
    entries = [(rng.choice(["l1", "l2", "allow"]), *rng.choice(kinds), rng.choice(["add", "remove"]), at()) for _ in range(150)]
    urls = ["http://a.b.org", "HTTP://u:p@A.B.org:80/x/y/z?q#f", "http://a.b.org./x", "https://c.b.org/x", "http://b.org/X", "x.org", "http://[::1]/x", "", None]
    captures = [(n, rng.choice(urls), at() + timedelta(hours=rng.choice([0, 0, 5])), 1) for n in range(400)] + [(999, urls[0], None, 1)]
    left = spark.createDataFrame(captures, "id long, url string, fetched_at timestamp, kind int")
    right = spark.createDataFrame(entries, "list string, kind string, pattern string, action string, at timestamp")
    matches = {0: {0, 1, 2}, 1: {0, 1, 2, 3, 4}, 2: {0, 1, 2, 3}, 3: {1, 2}, 4: {1, 2}}

    def active(name, pattern, t):
        known = sorted((e[4], e[3] == "add") for e in entries if e[0] == name and e[1:3] == pattern and e[4] <= t)
        return bool(known) and known[-1][1]

    rows = {r["id"]: r for r in U.judge(left, right).collect()}
    assert len(rows) == len(captures)
    for n, url, t, _ in captures:
        r = rows[n]
        assert r["kind"] == 1
        if url is None or t is None:
            assert (r["lists"], r["allowed"], r["blocked"]) == (None, None, None)
            continue
        hit = [k for i, k in enumerate(kinds) if i in matches.get(urls.index(url), ())]
        held = {name for name in ("l1", "l2", "allow") if any(active(name, k, t) for k in hit)}
        assert (r["lists"], r["allowed"], r["blocked"]) == (sorted(held - {"allow"}), "allow" in held, bool(held - {"allow"}) and "allow" not in held)


def test_edge_cases(spark):
    captures = spark.createDataFrame([("http://h/" + "s/" * 20_000, START, "x", "k")] * 2, "url string, fetched_at timestamp, _held string, blocked string")
    none = spark.createDataFrame([("l", None, "h", "add", START)], "list string, kind string, pattern string, action string, at timestamp")
    assert [r["blocked"] for r in U.judge(captures, none).collect()] == [False, False]
    some = spark.createDataFrame([("l", "prefix", "h/s/s", "add", START), ("l", "prefix", "h/s/s", "add", START)], none.schema)
    assert [(r["blocked"], r["lists"], r["_url"] if "_url" in r else None) for r in U.judge(captures, some).collect()] == [(True, ["l"], None)] * 2
    assert U.judge(captures.limit(0), some).count() == 0
