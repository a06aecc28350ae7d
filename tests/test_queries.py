"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", [name for name in contract.queries() if name in contract.ORACLE])
def test_query_matches_sql(spark, con, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    assert compare(result, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["state", "average_price", "count"]
