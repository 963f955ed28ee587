"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from feedmetrics.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert name in entry.oracle_sql()
    assert compare(spark, duck, name, SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
