"""The text queries against their SQL on the smallest folder; the driver does so on a larger one."""

import pytest

from tests.conftest import SMALL
from tests.oracle_check import compare, connect, rows_of_spark, rows_of_sql
from tickloom.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = rows_of_spark(queries()[name](spark, SMALL))
    assert compare(got, rows_of_sql(con, oracle_sql()[name])) is None
    assert got[1]
