from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farekit import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "farekit-tests",
        "local[4]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="2000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


@pytest.fixture
def rows_of(spark):
    """Evaluate rule columns over literal rows and give the values back."""

    def run(schema: str, rows: list[tuple], *columns):
        return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]

    return run
