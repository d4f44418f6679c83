"""Every query against its SQL answer on the smallest tables."""

import pytest

import __spark_entry__ as contract
from verification.compare import compare, connect
from verification.oracles import ORACLES
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    count, difference = compare(
        spark, con, SF_DIR, contract.queries()[name], contract.oracle_sql()[name])
    assert count > 0 and not difference, difference


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["country_name", "date"] and df.count() == 218
