"""Every registered query against its SQL on the given tables."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as entry
from feedpulse.plans.catalog import QUERIES
from feedpulse.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    expected = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert expected.num_rows > 0
    assert_same(entry.queries()[name](spark, SF_DIR).toArrow(), expected)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
