"""Every contract query against its DuckDB SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from flightlens.plans import contract, oracle
from oracle_harness import compare, duckdb_connection

from conftest import SF_SMALL

SQL = oracle.oracle_sql()
QUERIES = contract.registry()
MODEL_FITS = {"gbt_departure", "gbt_arrival", "evaluate_models"}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_sql_except_model_fits():
    assert set(QUERIES) - set(SQL) == MODEL_FITS
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con)
    assert result["match"], result


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "departure_delay_minutes", "arrival_delay_minutes", "delay_time"]
