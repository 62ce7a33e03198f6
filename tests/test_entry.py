"""The driver contract, and some registered queries against DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import TABLES, normal, rows_of
from oracles import ORACLES
from registry import QUERIES

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().keys() >= QUERIES.keys() and contract.oracle_sql().keys() >= ORACLES.keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys()


@needs_data
def test_entry(spark):
    df = contract.entry(spark)
    assert "transaction_sk" in df.columns and df.count() > 0
    assert {kind for _, kind in df.dtypes} <= {"string", "bigint", "double", "boolean"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA / table}.parquet'")
    return connection


@needs_data
@pytest.mark.parametrize(
    "name",
    """customer_360 loan_portfolio_analysis fct_transactions segment_analysis transaction_patterns txn_rolling_measures_split
    flag_price_percentiles_split order_priority_rank_ntile proximity_pairs date_spine_daily_orders upsert_moved_rows check_suite_lineitem""".split(),
)
def test_query_equals_duckdb(spark, duck, name):
    got, want = QUERIES[name](spark, str(DATA)).toPandas(), duck.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(normal, rows_of(got)), key=repr) == sorted(map(normal, rows_of(want)), key=repr)
