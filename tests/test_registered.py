"""Every registered query beside its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF_DIR = entry.SAMPLE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    own = {n for n in entry.queries() if n.startswith("q_")}
    assert own == {n for n in entry.oracle_sql() if n.startswith("q_")}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
