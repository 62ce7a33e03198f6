"""Run a suite of checks over a table into a table of results."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.reshape import COMPARE
from . import rows, tables

THRESHOLD = re.compile(r"\s*(=|!=|<>|<|<=|>|>=)\s*(\d+)\s*")

RowsOf = Callable[[DataFrame], DataFrame]

# How a check's failures are counted, where that is not the number of its rows.
_DIFFERENT = lambda side: F.count_if(F.col("which_diff") == side)
FAIL_CALC: dict[str, Callable[[], Column]] = {
    "equal_rowcount": lambda: F.coalesce(F.sum("diff_count"), F.lit(0)),
    "fewer_rows_than": lambda: F.coalesce(F.sum("row_count_delta"), F.lit(0)),
    "equality": lambda: F.count(F.lit(1)) + F.abs(_DIFFERENT("a_minus_b") - _DIFFERENT("b_minus_a")),
}


@dataclass(frozen=True)
class Check:
    """One check of a suite.

    Give ``violated`` for a condition on single rows, else ``violations``.
    ``where`` keeps rows of the table to look at; the thresholds compare the
    number of failures, for example ``">10"``.
    """

    name: str
    violated: Column | None = None
    violations: RowsOf | None = None
    failures: Callable[[], Column] | None = None
    where: str | None = None
    severity: str = "error"
    error_if: str = "!=0"
    warn_if: str = "!=0"

    def __post_init__(self):
        if (self.violated is None) == (self.violations is None):
            raise ValueError(f"{self.name}: give either violated or violations")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"{self.name}: severity must be 'error' or 'warn'")
        for bound in (self.error_if, self.warn_if):
            if not THRESHOLD.fullmatch(bound):
                raise ValueError(f"{self.name}: cannot read threshold {bound!r}")


def check(function: Callable, *args, name: str | None = None, where: str | None = None, **options) -> Check:
    """A suite entry from one of the check functions of this package."""
    limits = {k: options.pop(k) for k in ("severity", "error_if", "warn_if") if k in options}
    label = name or "_".join([function.__name__, *[a for a in args if isinstance(a, str)]])
    return Check(
        label,
        violations=lambda df: function(df, *args, **options),
        failures=FAIL_CALC.get(function.__name__),
        where=where,
        **limits,
    )


def row_check(name: str, violated: Column, **options) -> Check:
    return Check(name, violated=violated, **options)


def not_null_check(c: str, **options) -> Check:
    return Check(f"not_null_{c}", violated=F.col(c).isNull(), **options)


def unique_check(c: str, **options) -> Check:
    return check(tables.unique, c, **options)


def accepted_range_check(c: str, min_value=None, max_value=None, inclusive: bool = True, **options) -> Check:
    return Check(f"accepted_range_{c}", violated=rows.out_of_range(c, min_value, max_value, inclusive), **options)


def _beyond(failures: Column, bound: str) -> Column:
    sign, number = THRESHOLD.fullmatch(bound).groups()
    return COMPARE[sign](failures, F.lit(int(number)))


def _status(one: Check, failures: Column) -> Column:
    fails = _beyond(failures, one.error_if) if one.severity == "error" else F.lit(False)
    return F.when(fails, "error").when(_beyond(failures, one.warn_if), "warn").otherwise("pass")


def run_checks(df: DataFrame, suite: Sequence[Check], table: str = "table") -> DataFrame:
    """One row (table, check_name, failures, status) per check.

    All row conditions are counted together in one pass; each other check adds
    the work its own definition needs.
    """
    results = []
    by_row = [one for one in suite if one.violated is not None]
    if by_row:
        counted = [
            F.count_if((F.expr(one.where) if one.where else F.lit(True)) & one.violated).alias(f"_{i}")
            for i, one in enumerate(by_row)
        ]
        totals = df.agg(*counted)
        entries = [
            F.struct(F.lit(one.name).alias("check_name"), F.col(f"_{i}").alias("failures"), _status(one, F.col(f"_{i}")).alias("status"))
            for i, one in enumerate(by_row)
        ]
        spread = totals.select(F.explode(F.array(*entries)).alias("_e"))
        results.append(spread.select(F.lit(table).alias("table"), "_e.*"))
    for one in suite:
        if one.violations is None:
            continue
        found = one.violations(df.filter(one.where) if one.where else df)
        failures = one.failures() if one.failures else F.count(F.lit(1))
        counted = found.agg(failures.cast("bigint").alias("failures"))
        results.append(
            counted.select(
                F.lit(table).alias("table"), F.lit(one.name).alias("check_name"), "failures", _status(one, F.col("failures")).alias("status")
            )
        )
    return reduce(DataFrame.unionByName, results)
