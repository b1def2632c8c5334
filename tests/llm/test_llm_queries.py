"""Registered queries against their SQL in another engine, whole tables compared."""

import os

import pytest

from engines import connect, in_duckdb, in_spark
from weftable.llm import queries as registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = registered.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert in_spark(registered.queries()[name](spark, FOLDER)) == in_duckdb(connect(FOLDER), ORACLE[name])
