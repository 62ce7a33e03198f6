"""Number and date generators, and filling the gaps of a fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.casts import column

PERIODS_PER_BLOCK = 4096
PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..upper_bound, produced inside the tasks."""
    if upper_bound <= 0:
        raise ValueError(f"upper bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def _part(datepart: str) -> str:
    if datepart not in PARTS:
        raise ValueError(f"datepart must be one of {PARTS}, got {datepart!r}")
    return datepart.upper()


_MICROS = {"SECOND": 1_000_000, "MINUTE": 60_000_000, "HOUR": 3_600_000_000}


def _later(part: str, n: Column, first: Column) -> Column:
    """``n`` periods after ``first``; short periods may be more than 2**31."""
    if part in _MICROS:
        return F.timestamp_micros(F.unix_micros(first) + n.cast("bigint") * _MICROS[part])
    return F.timestamp_add(part, n.cast("int"), first)


def date_spine(spark: SparkSession, datepart: str, start: str, end: str, name: str | None = None) -> DataFrame:
    """One row per ``datepart`` from start up to, not including, end."""
    part, name = _part(datepart), name or f"date_{datepart}"
    kind = "date" if part in ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR") else "timestamp"
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    count = spark.range(1).select(F.timestamp_diff(part, first, last)).first()[0]
    numbered = spark.range(max(count, 0) + 1)
    moment = _later(part, F.col("id"), first)
    return numbered.select(moment.alias("_t")).filter(F.col("_t") < last).select(F.col("_t").cast(kind).alias(name))


def fill_periods(
    facts: DataFrame,
    datepart: str,
    moment: str,
    start: str,
    end: str,
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
    period: str = "period",
) -> DataFrame:
    """One row per period and key, with 0 where the facts have no row.

    Facts are aggregated per period first, so only the small result is joined.
    """
    part = _part(datepart)
    spine = date_spine(facts.sparkSession, datepart, start, end, period)
    kind = spine.schema[period].dataType
    grid = spine
    if keys:
        # each key makes the periods itself, in two steps so that no row holds more than a block of them
        first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
        most = F.greatest(F.timestamp_diff(part, first, last), F.lit(0).cast("bigint"))  # an end before the start has no periods
        blocks = F.sequence(F.lit(0).cast("bigint"), most, F.lit(PERIODS_PER_BLOCK).cast("bigint"))
        inside = F.sequence(F.col("_block"), F.col("_block") + (PERIODS_PER_BLOCK - 1))
        numbered = facts.select(*keys).distinct().filter(first < last).withColumn("_block", F.explode(blocks)).withColumn("_i", F.explode(inside))
        at = _later(part, F.col("_i"), first)
        grid = numbered.withColumn(period, at).filter(F.col(period) < last).withColumn(period, F.col(period).cast(kind)).drop("_block", "_i")
    inside = (column(moment) >= F.lit(start).cast("timestamp")) & (column(moment) < F.lit(end).cast("timestamp"))
    # periods are counted from the start, as the spine does
    offset = F.timestamp_diff(part, F.lit(start).cast("timestamp"), column(moment).cast("timestamp"))
    own_period = _later(part, offset, F.lit(start).cast("timestamp")).cast(kind)
    sums = facts.filter(inside).groupBy(*keys, own_period.alias(period)).agg(*[c.alias(n) for n, c in measures.items()])
    left, right = grid.alias("g"), sums.alias("s")
    same = F.col(f"g.{period}") == F.col(f"s.{period}")
    for key in keys:
        same = same & F.col(f"g.{key}").eqNullSafe(F.col(f"s.{key}"))
    return left.join(right, same, "left").select(
        *[F.col(f"g.{key}") for key in keys],
        F.col(f"g.{period}"),
        *[F.coalesce(F.col(f"s.{n}"), F.lit(0)).alias(n) for n in measures],
    )
