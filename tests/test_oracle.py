"""Every registered query equals its DuckDB oracle (sf0.001)."""
import pytest

import __spark_entry__ as E
from tideline.plans.oracle import oracle_sql
from tideline.plans.queries import QUERIES
from tideline.plans.verify import compare, duckdb_conn
from conftest import SF_SMALL

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, E.queries(), E.oracle_sql(), con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "if_first_order" in df.columns
