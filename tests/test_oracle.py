"""Every query against its SQL on the smallest test tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from conceptree.suite.oracle import all_oracles
from conceptree.suite.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    assert difference(all_queries()[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
