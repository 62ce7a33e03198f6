"""Aggregate and window expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec, functions as F

from .casts import column


def rolling_mean(c: Column | str, window: WindowSpec, rows_back: int = 30) -> Column:
    """Mean of the current row and up to ``rows_back`` rows before it."""
    return F.avg(column(c)).over(window.rowsBetween(-rows_back, Window.currentRow))


def running_sum(c: Column | str, window: WindowSpec) -> Column:
    return F.sum(column(c)).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def deviation_parts(c: Column | str) -> dict[str, Column]:
    """Aggregates of a decimal or integer column that ``deviation`` is taken from.

    Sums of hundredths and of their squares are exact, so the deviation does not depend on the order of rows
    or on the way a group was split.
    """
    hundredths = F.round(column(c) * 100).cast("decimal(18,0)")
    return {"_n": F.count(column(c)), "_sum": F.sum(hundredths), "_squares": F.sum(hundredths * hundredths)}


def deviation() -> Column:
    """Sample standard deviation from ``deviation_parts``; NULL for fewer than two values."""
    n, total, squares = F.col("_n"), F.col("_sum"), F.col("_squares")
    exact = F.try_subtract(F.try_multiply(n.cast("decimal(18,0)"), squares), F.try_multiply(total, total)).cast("double")
    # sums too long for a decimal: as doubles, still the same in any order
    spread = F.coalesce(exact, n.cast("double") * squares.cast("double") - total.cast("double") * total.cast("double"))
    variance = F.greatest(spread, F.lit(0.0)) / (n * (n - 1)).cast("double")
    return F.when(n > 1, F.sqrt(variance) / 100)


def share_percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100
