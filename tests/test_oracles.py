"""Every query against its SQL on the smallest tables (ragged keys, many empty hours)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from demandtide.plans.oracles import ORACLES
from demandtide.plans.queries import QUERIES
from tests.compare import connect, difference
from tests.conftest import SF

SQL = {name: sql for name, sql in oracle_sql().items() if name in ORACLES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    rows = queries()[name](spark, SF).collect()
    assert rows
    assert not any(isinstance(v, float) and v != v for r in rows for v in r), "NaN must not leave an operator"


def test_entry(spark):
    assert entry(spark).count() == 10
