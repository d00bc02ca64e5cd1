"""Every query against its SQL on a whole test folder."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tickloom import catalog
from tests.conftest import CHECKED
from tests.oracle_check import compare, connect, rows_of_spark, rows_of_sql


@pytest.fixture(scope="module")
def con():
    return connect(CHECKED)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, con, name):
    got = rows_of_spark(catalog.queries()[name](spark, CHECKED))
    expected = rows_of_sql(con, catalog.oracle_sql()[name])
    assert compare(got, expected) is None
    assert got[1], "a query should have rows to compare"


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() == 397
    assert dict(result.dtypes)["trade_date"] == "date"
    assert dict(result.dtypes)["ma_20_day"] == "double"
