"""Driver contract: entry, queries, oracles."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

from gridcast.plans.catalog import QUERIES  # noqa: E402
from gridcast.plans.oracle import ORACLE  # noqa: E402


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(ORACLE) == {"forecast_backtest"} and set(ORACLE) <= set(QUERIES) <= set(q)  # boosted trees have no SQL
    assert len(QUERIES) >= 109


def test_a_missing_module_costs_only_its_queries(monkeypatch):
    real = E.importlib.import_module

    def lacking(name, *args):
        if name.startswith("gridcast.llm"):
            raise ModuleNotFoundError("No module named 'xxhash'", name="xxhash")
        return real(name, *args)

    monkeypatch.setattr(E.importlib, "import_module", lacking)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["series_id", "timestamp", "target_demand", "season"]
