"""Queries that SQL can express against their SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from millrace.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with duckdb.connect() as connection:
        for path in glob.glob(f"{SF}/*.parquet"):
            connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
        yield connection


@pytest.mark.parametrize("name", sorted(set(queries.SQL) - {"op11_filter_audit", "op13_source_mix"}))
def test_twin(spark, duck, name):
    """The others are compared beside their own tests, on two tables."""
    found = queries.QUERIES[name](spark, SF)
    result = duck.execute(queries.SQL[name])
    names = [c[0] for c in result.description]
    expected = sorted(tuple(map(str, row)) for row in result.fetchall())
    assert names == found.columns
    assert sorted(tuple(map(str, row)) for row in found.collect()) == expected and expected
