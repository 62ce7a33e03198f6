"""Checks over groups, orders and pairs of tables; each returns its violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.casts import AsOf, column, moment
from ..functions.expressions import slugify
from ..operators.keyed import keyed_windows
from ..operators.ordered import HOT_ROWS, find_hot, prefix_maxima, split_hot


def at_least_one(df: DataFrame, c: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without any value; ungrouped, one row if the table has none."""
    if group_by:
        counts = df.groupBy(*group_by).agg(F.count(column(c)).alias("filler_column"))
    else:
        # one row is enough to pass, so the scan may stop at the first
        counts = df.filter(column(c).isNotNull()).select(c).limit(1).agg(F.count(column(c)).alias("filler_column"))
    return counts.filter(F.col("filler_column") == 0)


def not_constant(df: DataFrame, c: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose column has exactly one value."""
    # min = max says the same as one distinct value, without a second shuffle
    counts = df.groupBy(*group_by).agg(F.min(column(c)).alias("_lo"), F.max(column(c)).alias("_hi"))
    return counts.filter(F.col("_lo") == F.col("_hi")).select(*group_by, F.lit(1).cast("bigint").alias("filler_column"))


def not_null_proportion(
    df: DataFrame, c: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = F.try_divide(F.count(column(c)), F.count(F.lit(1)))
    shares = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return shares.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    as_of: AsOf = None,
) -> DataFrame:
    """Groups whose newest row is older than ``interval`` date parts; no row passes."""
    kind = "date" if ignore_time_component else "timestamp"
    threshold = F.timestamp_add(datepart.upper(), F.lit(-interval), moment(as_of)).cast(kind)
    newest = df.groupBy(*group_by).agg(F.max(column(field)).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", threshold).filter(F.col("most_recent") < F.col("threshold"))


def unique_combination_of_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Combinations met more than once; NULLs count as equal."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > 1).select(*cols)


def unique(df: DataFrame, c: str) -> DataFrame:
    """Non-NULL values met more than once."""
    counts = df.filter(column(c).isNotNull()).groupBy(column(c).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def relationships_where(
    df: DataFrame, c: str, to: DataFrame, field: str, from_condition: str = "true", to_condition: str = "true"
) -> DataFrame:
    """Non-NULL keys without a partner, one row per orphan."""
    left = df.filter(from_condition).filter(column(c).isNotNull()).select(column(c).alias("id"))
    right = to.filter(to_condition).filter(column(field).isNotNull()).select(column(field).alias("id"))
    orphans = left.join(right, "id", "left_anti")
    return orphans.select("id", F.lit(None).cast(right.schema["id"].dataType).alias("right_id"))


def cardinality_equality(df: DataFrame, c: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) rows found on one side only; NULL is a value."""
    a = df.groupBy(column(c).alias(c)).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(column(field).alias(c)).agg(F.count(F.lit(1)).alias("num_rows"))
    return a.subtract(b).unionAll(b.subtract(a))


def equality(df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Rows of one table missing in the other, tagged by side.

    Compared as sets; ``exact`` also compares how often a row occurs.
    """
    cols = list(compare_columns or df.columns)
    a, b = df.select(*cols), compare.select(*cols)
    minus = (lambda x, y: x.exceptAll(y)) if exact else (lambda x, y: x.subtract(y))
    tag = lambda rows, side: rows.select(F.lit(side).alias("which_diff"), *cols)
    return tag(minus(a, b), "a_minus_b").unionAll(tag(minus(b, a), "b_minus_a"))


def _side_counts(df: DataFrame, compare: DataFrame, group_by: Sequence[str], name_a: str, name_b: str) -> DataFrame:
    a = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(name_a))
    b = compare.groupBy(*group_by).agg(F.count(F.lit(1)).alias(name_b))
    if not group_by:
        return a.crossJoin(F.broadcast(b))  # one row each
    a = a.select(*[F.col(g).alias(f"{g}_a") for g in group_by], name_a)
    b = b.select(*[F.col(g).alias(f"{g}_b") for g in group_by], name_b)
    on = [F.col(f"{g}_a") == F.col(f"{g}_b") for g in group_by]
    pairs = [c for g in group_by for c in (f"{g}_a", f"{g}_b")]
    return a.join(b, on, "full").select(*pairs, name_a, name_b)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side; ``diff_count`` is NULL for a group on one side only."""
    counts = _side_counts(df, compare, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side; ``row_count_delta`` is 0 where the table is smaller."""
    counts = _side_counts(df, compare, group_by, "count_our_model", "count_comparison_model")
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1)).otherwise(F.lit(0))
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


# How an upper bound must relate to the next lower bound.
GAPS = {
    "not_allowed": ("equal_to", lambda a, b: a == b),
    "allowed": ("less_than_or_equal_to", lambda a, b: a <= b),
    "required": ("less_than", lambda a, b: a < b),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str | Column,
    upper: str | Column,
    partition_by: str | Column | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Ranges that are empty, reversed, unbounded or that clash with the next one."""
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {list(GAPS)}, got {gaps!r}")
    if not isinstance(zero_length_range_allowed, bool):
        raise ValueError("zero_length_range_allowed must be True or False")
    gap_words, gap_holds = GAPS[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    keys = [] if partition_by is None else ["partition_by_col"]
    ranges = df.select(
        *([] if partition_by is None else [column(partition_by).alias("partition_by_col")]),
        column(lower).alias("lower_bound"),
        column(upper).alias("upper_bound"),
    )
    # backwards, the next range is the previous row and the last range the first one
    backwards = [F.col("lower_bound").desc(), F.col("upper_bound").desc()]
    framed = {
        "next_lower_bound": lambda w: F.lag("lower_bound").over(w),
        "_has_next": lambda w: F.lag(F.lit(True)).over(w),
    }
    seen = keyed_windows(ranges, keys, backwards, framed, rows_back=1, hot_rows=hot_rows)
    low, high = F.col("lower_bound"), F.col("upper_bound")
    length_ok = F.coalesce(low <= high if zero_length_range_allowed else low < high, F.lit(False))
    is_last = F.col("_has_next").isNull()
    order_ok = F.coalesce(gap_holds(high, F.col("next_lower_bound")), is_last, F.lit(False))
    length_name, order_name = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{gap_words}_next_lower_bound"
    judged = seen.select(
        *keys,
        "lower_bound",
        "upper_bound",
        "next_lower_bound",
        is_last.alias("is_last_record"),
        length_ok.alias(length_name),
        order_ok.alias(order_name),
    )
    return judged.filter(~(F.col(length_name) & F.col(order_name)))


def overlapping_ranges(
    df: DataFrame,
    lower: str | Column,
    upper: str | Column,
    partition_by: str | Column | None = None,
    hot_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Ranges that begin before an earlier one has ended, also one that lies inside an earlier, longer one.

    ``mutually_exclusive_ranges`` looks at the next range only. ``reached`` is the largest upper bound of the ranges
    before, by lower and upper bound. Upper bounds do not belong to their range; ranges without length or with a NULL
    bound cover nothing and are left out. A key of more than ``hot_rows`` ranges is spread over range partitions.
    """
    keys = [] if partition_by is None else ["partition_by_col"]
    ranges = df.select(
        *([] if partition_by is None else [column(partition_by).alias("partition_by_col")]),
        column(lower).alias("lower_bound"),
        column(upper).alias("upper_bound"),
    ).filter("lower_bound < upper_bound")
    order = [F.col("lower_bound"), F.col("upper_bound")]
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    spread = lambda rows, groups: prefix_maxima(rows, order, "upper_bound", keys, groups, partitions=partitions)
    if not keys:
        seen = spread(ranges, 1)
    else:
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        plain = lambda rows: rows.withColumn("reached", F.max("upper_bound").over(before))
        large = find_hot(ranges, keys, hot_rows)
        if large is None:
            seen = plain(ranges)
        else:
            hot, cold = split_hot(ranges, large, keys, store=True)
            seen = plain(cold).unionByName(spread(hot, large.groups))
    return seen.filter(F.col("lower_bound") < F.col("reached"))


def sequential_values(
    df: DataFrame,
    c: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    hot_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Rows that do not follow the previous value by ``interval``."""
    previous = f"previous_{slugify(c)}"
    values = df.select(*[g for g in group_by if g != c], c)
    framed = {previous: lambda w: F.lag(F.col(c)).over(w)}
    seen = keyed_windows(values, list(group_by), [F.col(c).asc()], framed, rows_back=1, hot_rows=hot_rows, partitions=partitions)
    if datepart:
        expected = F.timestamp_add(datepart.upper(), F.lit(interval), F.col(previous).cast("timestamp"))
        return seen.filter(F.col(c).cast("timestamp") != expected)
    return seen.filter(F.col(c) != F.col(previous) + interval)


def columns_match_set(df: DataFrame, column_list: Sequence[str]) -> DataFrame:
    """Names found only in the table or only in the list, whatever their case."""
    spark = df.sparkSession
    table = spark.createDataFrame([(c.upper(),) for c in df.columns], "relation_column string")
    listed = spark.createDataFrame([(c.upper(),) for c in column_list], "input_column string")
    both = table.join(listed, F.col("relation_column") == F.col("input_column"), "full")
    return both.filter(F.col("relation_column").isNull() | F.col("input_column").isNull())
