"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_points
import check_queries
from conftest import TEST_DATA
from opsframe.plans import REGISTERED


@pytest.fixture(scope="module")
def connection():
    return check_queries.database(TEST_DATA)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"]
    assert df.count() > 0


def test_every_query_has_its_sql():
    assert set(REGISTERED) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, connection, name):
    found = entry_points.queries()[name](spark, TEST_DATA).toArrow()
    wanted = connection.sql(entry_points.oracle_sql()[name]).to_arrow_table()
    assert check_queries.compare(found, wanted) == ""
    assert found.num_rows > 0
