"""One local session for all tests. Code generation may not fall back silently."""

from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402
from millrace.sources.messages import message_schema  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, **{"spark.sql.codegen.fallback": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def utc(spark):
    """Undo a test's change of the session zone."""
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def make_messages(spark):
    """Messages from (topic, partition, offset, seconds, value) rows, seconds from 2024-01-01."""

    def make(rows, ntz=True):
        base = datetime(2024, 1, 1).timestamp()
        data = [
            (None, value, topic, partition, offset, datetime.fromtimestamp(base + seconds))
            for topic, partition, offset, seconds, value in rows
        ]
        return spark.createDataFrame(data, message_schema(ntz))

    return make
