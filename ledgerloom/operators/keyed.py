"""Windows per key that survive a key holding a third of the table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..session import scratch_dir
from .ordered import HOT_ROWS, Hot, find_hot, fitting, partitions_for, positions, same_keys, size_of, split_hot
from .percentiles import Targets, exact_percentiles, large_percentiles

Framed = Mapping[str, Callable[[WindowSpec], Column]]


def keyed_windows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    framed: Framed | None = None,
    running: Mapping[str, str] | None = None,
    totals: Mapping[str, Column] | None = None,
    percentiles: Targets | None = None,
    rows_back: int = 0,
    counts: DataFrame | None = None,
    at_most: DataFrame | int | None = None,
    hot_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add window columns per ``keys`` in ``order_by``, which must be a total order.

    ``framed``: new column -> window expression looking back at most ``rows_back`` rows;
    ``running``: new column -> column whose running sum it holds;
    ``totals``: new column -> aggregate over all rows of the key;
    ``percentiles``: new column -> (column, fraction) over all rows of the key.

    Keys of at most ``hot_rows`` rows share one exchange, one sort and one
    window. A larger key is cut into blocks of consecutive positions; each
    block also gets the ``rows_back`` rows before it, and sums of earlier blocks
    are added on. Its totals are plain aggregates joined back. ``counts`` and
    ``at_most`` as in ``find_hot``. Without keys the whole table is one group
    and always takes the split form. Both forms give the same values where sums are
    exact: aggregates over decimals and integers, not over doubles.
    """
    framed, running, totals = dict(framed or {}), dict(running or {}), dict(totals or {})
    percentiles = dict(percentiles or {})
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    scratch_dir(df.sparkSession)  # wanted at every size, so that a growing key changes no requirement

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order_by)
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        added = [f(window).alias(n) for n, f in framed.items()]
        added += [F.sum(c).over(upto).alias(n) for n, c in running.items()]
        added += [agg.over(whole).alias(n) for n, agg in totals.items()]
        added += [F.percentile(F.col(c).cast("double"), F.lit(p)).over(whole).alias(n) for n, (c, p) in percentiles.items()]
        return rows.select("*", *added)

    def split(rows: DataFrame, large: Hot, like: DataFrame) -> DataFrame:
        spread = partitions or partitions_for(large.rows)
        out = _in_blocks(rows, large, keys, order_by, framed, running, totals, percentiles, rows_back, hot_rows, spread)
        return _typed_like(like, out)

    if not keys:
        return split(df, Hot(df.limit(0), 1, size_of(df if at_most is None else at_most)), plain(df))
    large = find_hot(df, keys, hot_rows, counts, at_most)
    if large is None:
        return plain(df)
    hot, cold = split_hot(df, large, keys, store=True)
    bounded = plain(cold)
    return bounded.unionByName(split(hot, large, bounded))


def _typed_like(model: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in model.schema.fields])


def _in_blocks(
    df: DataFrame,
    large: Hot,
    keys: Sequence[str],
    order_by: Sequence[Column],
    framed: Framed,
    running: Mapping[str, str],
    totals: Mapping[str, Column],
    percentiles: Targets,
    rows_back: int,
    hot_rows: int,
    partitions: int,
) -> DataFrame:
    block = max(hot_rows, rows_back, 1)
    placed = positions(df, order_by, keys, large.groups, "_pos", partitions)
    placed = placed.withColumn("_block", F.floor((F.col("_pos") - 1) / block))

    here = F.struct(F.col("_block").alias("block"), F.lit(False).alias("copy"))
    copies = F.array(here)
    if rows_back:
        # the next block sees the last rows of this one
        ahead = F.struct((F.col("_block") + 1).alias("block"), F.lit(True).alias("copy"))
        near_end = (F.col("_pos") - 1) % block >= block - rows_back
        copies = F.when(near_end, F.array(here, ahead)).otherwise(copies)
    copied = placed.withColumn("_c", F.explode(copies)).select(
        *df.columns, "_pos", F.col("_c.block").alias("_block"), F.col("_c.copy").alias("_copy")
    )

    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = [f(window).alias(n) for n, f in framed.items()]
    added += [F.sum(F.when(~F.col("_copy"), F.col(c))).over(upto).alias(n) for n, c in running.items()]
    result = copied.select("*", *added).filter(~F.col("_copy")).drop("_copy", "_pos")

    if running:
        # one row per block: sums of everything before it
        sums = placed.groupBy(*keys, "_block").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in running.items()])
        earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select(*keys, "_block", *[F.sum(f"_sum_{n}").over(earlier).alias(f"_off_{n}") for n in running])
        blocks = large.rows // block + large.groups
        joined = result.alias("w").join(fitting(sums.alias("b"), blocks), same_keys("w", "b", [*keys, "_block"]))

        def total(n: str) -> Column:
            local, offset = F.col(f"w.`{n}`"), F.col(f"b._off_{n}")
            # a sum stays NULL until its first value, as in a plain window
            return F.coalesce(local + F.coalesce(offset, F.lit(0)), offset)

        rest = [c for c in result.columns if c not in running]
        result = joined.select(*[F.col(f"w.`{c}`") for c in rest], *[total(n).alias(n) for n in running])
    result = result.drop("_block")

    # one row per large key
    groups = [placed.groupBy(*keys).agg(*[agg.alias(n) for n, agg in totals.items()])] if totals else []
    if percentiles and keys:
        groups.append(large_percentiles(df, large, keys, percentiles))
    elif percentiles:
        groups.append(exact_percentiles(df, [], percentiles, at_most=large.rows, hot_rows=hot_rows))
    for group in groups:
        names = [c for c in group.columns if c not in keys]
        joined = result.alias("w").join(fitting(group.alias("g"), large.groups), same_keys("w", "g", keys))
        result = joined.select(*[F.col(f"w.`{c}`") for c in result.columns], *[F.col(f"g.`{n}`") for n in names])
    return result
