"""Every registered check against its DuckDB statement on the sf0.01 tables."""

import pytest

from conftest import SF_CHECK
from sluice.suite import load_all
from sluice.suite.compare import compare, duck

REGISTRY = load_all()
WITH_SQL = sorted(k for k, (_f, sql) in REGISTRY.items() if sql)
ROWS_ONLY = sorted(k for k, (_f, sql) in REGISTRY.items() if not sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, con, name):
    fn, sql = REGISTRY[name]
    res = compare(fn(spark, SF_CHECK), con, sql)
    assert res["columns_match"], res
    assert "type_mismatch" not in res, res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
