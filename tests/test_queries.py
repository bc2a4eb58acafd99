"""Every registered query against its SQL."""

import pytest
from conftest import SF_DIR
from oracle import compare, duck

from catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SF_DIR) == []


def test_entry_functions(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).limit(1).count() == 1
