"""Every registered query against its SQL at sf0.001."""

import pytest

import __spark_entry__ as entry
import oracle
from scenarios.oracles import ORACLES
from scenarios.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_all_registered():
    """Every query of the sync engine has its SQL; of the text queries only those that SQL can express."""
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    assert oracle.compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None
