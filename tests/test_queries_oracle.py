"""Every registered query against its DuckDB oracle (small scale factor)."""
import pytest

import __spark_entry__ as E
from relaymart.testing.compare import compare, duckdb_connection

# the corpus queries have tests of their own
QUERIES = {n: q for n, q in E.queries().items() if n not in E.LLM_QUERIES}
ORACLE = {n: sql for n, sql in E.oracle_sql().items() if n not in E.LLM_QUERIES}


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["email_subscriber_daily_id", "date_day", "subscriber_id", "is_subscribed"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert len(set(df.columns)) == len(df.columns), df.columns
    r = compare(df, ORACLE[name], con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
