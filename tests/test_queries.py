"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import compare, connect
from conftest import DATA, plan_of
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as entry
from tabprep.plans import catalog

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables not at hand")


@pytest.fixture(scope="module")
def con():
    return connect(str(DATA))


@pytest.fixture
def plans(monkeypatch):
    """Plans of everything a query writes down while it is built."""
    seen = []
    write = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append(plan_of(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, plans, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    plans.append(plan_of(df))
    for plan in plans:
        # No join forms all pairs, and nothing but workbooks and alert chains leaves the engine.
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert name.startswith(("A5", "A6_alert", "S2", "S6")) or "Python" not in plan and "InPandas" not in plan
    assert compare(con, catalog.ORACLES[name], df) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and "win_rate" in rows[0].asDict()


def test_every_query_has_a_counterpart():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
