"""Every registered query against its SQL, over whole tables."""

import pytest
from conftest import DATA

import __spark_entry__ as entry
from cohortspark.registry import ORACLE, QUERIES
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, con, name):
    problem = compare(spark, con, DATA, name)
    # At the smallest scale a few checks find nothing on either side.
    assert problem in (None, "EMPTY"), problem


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 150
