"""Every registered query against its DuckDB oracle (sf0.001; the driver
repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001
from threadlens.plans.compare import compare
from threadlens.plans.queries import QUERIES as REGISTERED

QUERIES = {k: f for k, f in entry_mod.queries().items() if k in REGISTERED}
ORACLES = {k: sql for k, sql in entry_mod.oracle_sql().items() if k in REGISTERED}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == set(REGISTERED)


#: Without rows on the smallest fixture (they have some at sf0.01).
EMPTY_AT_THIS_SIZE = {"q_engage_download", "q_hash_audit", "q_trend"}
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
             "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck001, name):
    df = QUERIES[name](spark, SF001)
    result = compare(df, duck001, ORACLES[name])
    assert result["columns_match"], result
    assert result["values_match"], result
    rel = duck001.sql(ORACLES[name])
    assert result["spark_rows"] > 0 or name in EMPTY_AT_THIS_SIZE, result
    oracle_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SQL_TYPES.get(t, t) for c, t in df.dtypes} == oracle_types


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["subreddit", "influential_user", "influence", "active_user", "activity"]
    assert df.count() > 0
