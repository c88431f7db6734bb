import warnings
import importlib.util
import os

from conftest import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_smoke_data(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["state", "offense_codes", "earliest_month", "latest_month", "total_rows"]


def test_every_sql_has_a_query():
    mod = _entry_module()
    q, sql = mod.queries(), mod.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 55
    # All checks of the library itself have SQL.
    assert set(q) - set(mod.LLM_QUERIES) <= set(sql)


def test_a_package_missing_from_the_operators_leaves_the_rest(monkeypatch):
    import sys
    monkeypatch.setitem(sys.modules, "sluice.llm.queries", None)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        mod = _entry_module()
    assert not mod.LLM_QUERIES and len(mod.queries()) == len(mod.oracle_sql()) > 80
