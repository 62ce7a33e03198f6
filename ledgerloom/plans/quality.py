"""The check suite of the published tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..checks.runner import not_null_check, run_checks, unique_check

# The key each published table must hold once and never NULL.
KEYS = {"dim_customers": "customer_id", "fct_transactions": "transaction_id", "fct_account_summary": "account_id"}


def mart_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """One result row per check of every given table."""
    results = [
        run_checks(df, [unique_check(KEYS[name]), not_null_check(KEYS[name])], table=name) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, results)
