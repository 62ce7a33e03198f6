"""Casts and date arithmetic that return NULL on bad input instead of failing."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

AsOf = Column | datetime | date | str | None


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(as_of: AsOf = None) -> Column:
    """The reference time of a job; the wall clock only where none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def safe_decimal(c: Column | str, precision: int = 15, scale: int = 2) -> Column:
    return column(c).try_cast(f"decimal({precision},{scale})")


def safe_timestamp(c: Column | str) -> Column:
    return column(c).try_cast("timestamp")


def date_diff(start: Column | str, end: Column | str, unit: str = "day") -> Column:
    """Whole elapsed units from start to end."""
    return F.timestamp_diff(unit.upper(), column(start), column(end))


def age_years(c: Column | str, as_of: AsOf = None) -> Column:
    """Calendar days up to ``as_of`` in years of 365.25 days, rounded down."""
    return F.floor(F.datediff(moment(as_of), column(c)) / F.lit(365.25))


def add_years(c: Column | str, years: int) -> Column:
    return column(c) + F.make_interval(F.lit(years))
