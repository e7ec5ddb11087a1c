"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from millrace.plans.catalog import CATALOG, check
from millrace.plans.oracle import SQL
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    check()
    assert set(CATALOG) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_twin(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    expected_types = {column[0]: str(column[1]) for column in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == expected_types
    order = [list(expected_types).index(c) for c in df.columns]
    expected = sorted(tuple(map(str, (row[i] for i in order))) for row in result.fetchall())
    assert sorted(tuple(map(str, row)) for row in df.collect()) == expected
    assert expected


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["window_start", "window_end", "count", "upsert_session", "track_event"]
    assert df.count() > 0
