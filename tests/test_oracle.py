"""Every query against its SQL on the driver tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OWN = {q.__name__: q for q in entry.QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


# What SQL cannot express is held against labels and brute force, in tests/test_instances.py and
# tests/test_sentence_ends.py.
WITHOUT_SQL = {"model_document_recall", "sentences_by_statistics"}


def test_every_query_has_sql():
    assert set(OWN) == set(SQL) | WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, entry.queries()[name], SQL[name], SF_DIR) == []


def test_entry_has_one_row_per_bucket(spark):
    assert entry.entry(spark).count() == 47


def test_report_without_posts_in_a_window_says_minus_one(spark):
    rows = {r.bucket: r for r in entry.window_report(spark, SF_DIR).collect()}
    assert rows[44].all_posts == 0 and rows[44].percent == -1
    assert sum(r.all_posts for r in rows.values()) == entry.documents(spark, SF_DIR).count()
