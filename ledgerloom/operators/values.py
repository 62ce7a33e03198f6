"""Value frequencies, single values, histograms and null-safe totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.casts import column
from ..functions.expressions import safe_add, safe_divide, safe_subtract, width_bucket


def value_frequencies(
    df: DataFrame,
    name: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Distinct values and their counts, most frequent first."""
    rows = df if where is None else df.filter(where)
    counts = rows.groupBy(column(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(*(order_by or [F.desc("n"), F.asc("value")]))
    return ordered if max_records is None else ordered.limit(max_records)


def column_values(
    spark: SparkSession,
    table: str | DataFrame,
    name: str,
    max_records: int | None = None,
    default: list | None = None,
    where: str | None = None,
    order_by: Sequence[Column] | None = None,
    refuse_above: int = 1000,
) -> list:
    """The values as a Python list, most frequent first or by ``order_by``, to name the columns of a pivot.

    ``max_records`` keeps the first so many. Without it all values are meant, and more than
    ``refuse_above`` of them raise instead of being left out: they have to fit on the driver.
    """
    if isinstance(table, str):
        if not spark.catalog.tableExists(table):
            if default is None:
                raise ValueError(f"table {table} does not exist and no default is given")
            return default
        table = spark.table(table)
    most = refuse_above + 1 if max_records is None else max_records
    found = value_frequencies(table, name, order_by, most, where).collect()
    if max_records is None and len(found) > refuse_above:
        raise ValueError(f"{name} has more than {refuse_above} distinct values")
    return [row["value"] for row in found] or (default if default is not None else [])


def single_value(df: DataFrame, default=None, name: str = "value") -> DataFrame:
    """First column of the first row as a one-row table; ``default`` if there is none."""
    kind = df.schema.fields[0].dataType
    # an ungrouped aggregate yields one row even for no input
    found = df.limit(1).select(F.struct(F.col(f"`{df.columns[0]}`").alias("v")).alias("_r")).agg(F.first("_r").alias("_r"))
    return found.select(F.when(F.col("_r").isNull(), F.lit(default).cast(kind)).otherwise(F.col("_r.v")).alias(name))


def histogram(df: DataFrame, name: str, low: float, high: float, buckets: int, total: str | None = None) -> DataFrame:
    """Rows and their sum per equal-width bucket; 0 and buckets + 1 hold the outliers."""
    bucket = width_bucket(name, low, high, buckets).cast("int").alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.sum(column(total or name)).alias("total"))


def net_totals(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Null-safe sum, difference and ratio of the columns' totals per group."""
    sums = df.groupBy(*group).agg(*[F.sum(column(c)).alias(f"_{i}") for i, c in enumerate(cols)])
    names = [f"_{i}" for i in range(len(cols))]
    rest = safe_add(names[1:]) if len(names) > 1 else F.lit(0)
    return sums.select(
        *group,
        safe_add(names).alias("net_sum"),
        safe_subtract(names).alias("net_difference"),
        safe_divide(F.coalesce(F.col(names[0]), F.lit(0)), F.nullif(rest, F.lit(0))).alias("net_ratio"),
    )
