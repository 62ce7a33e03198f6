"""Checks that look at one row at a time.

Each returns the violating rows. The ``*_violated`` expressions behind them
also let the runner count many checks in a single pass over the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import column


def out_of_range(c: Column | str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    value = column(c)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ~(value >= min_value if inclusive else value > min_value)
    if max_value is not None:
        bad = bad | ~(value <= max_value if inclusive else value < max_value)
    return bad


def accepted_range(df: DataFrame, c: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; NULL passes."""
    return df.filter(out_of_range(c, min_value, max_value, inclusive))


def expression_violated(expression: str, c: str | None = None) -> Column:
    return ~F.expr(f"({expression})" if c is None else f"(`{c}` {expression})")


def expression_is_true(df: DataFrame, expression: str, c: str | None = None) -> DataFrame:
    """Rows where the expression is false; with a column it is the expression's start."""
    return df.filter(expression_violated(expression, c))


def empty_violated(c: Column | str, trim_whitespace: bool = True) -> Column:
    value = column(c)
    return (F.trim(value) if trim_whitespace else value) == ""


def not_empty_string(df: DataFrame, c: str, trim_whitespace: bool = True) -> DataFrame:
    return df.filter(empty_violated(c, trim_whitespace))


def not_null(df: DataFrame, c: str) -> DataFrame:
    return df.filter(column(c).isNull())


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows whose two columns differ; a NULL on either side passes."""
    return df.filter(column(actual) != column(expected))


def not_accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Each forbidden value that occurs, once."""
    return df.filter(column(c).isin(*values)).select(column(c).alias("value_field")).distinct()


def accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Each value outside the list with its count."""
    outside = df.filter(~column(c).isin(*values))
    return outside.groupBy(column(c).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
