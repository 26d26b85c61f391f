"""Every registered query equals its DuckDB oracle (sf0.001, whole tables)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

ORACLE = E.oracle_sql()
#: The optional queries for training data are tested in their own folder.
QUERIES = {k: f for k, f in E.queries().items() if f.__module__ == E.__name__}


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF_SMALL, name, QUERIES[name], ORACLE.get(name))
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["pais", "valor_total", "participacao_pct"]
    assert 0 < len(rows) <= 10
    assert abs(sum(r["participacao_pct"] for r in rows) - 100.0) < 1e-9
