"""The queries that SQL can express, against their SQL."""

import pytest

import oracle
from rowferry.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None
