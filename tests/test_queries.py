"""Every registered query against its SQL statement."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert difference(frame, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 18
    assert "macro_f1" in frame.columns
