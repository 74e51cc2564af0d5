"""Operators that SQL can express, against DuckDB on the driver tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry
from eventpulse.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = oracle.connect(SF_DIR)
    assert oracle.compare(spark, con, queries.QUERIES[name], queries.ORACLE_SQL[name], SF_DIR) == []


def test_all_ten_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names
