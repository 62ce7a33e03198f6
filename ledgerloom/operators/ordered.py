"""Ordered computations that never put a large group into one task.

A plain window sends every row of a partition key to one task, and a window
without partition key sends the whole table there. Here rows are numbered and
summed over a range-partitioned, sorted table instead, where even one huge key
or one huge tie is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise, setting

# A key with more rows than this is split over several tasks.
HOT_ROWS = 1_000_000

# Range partitions are sized by rows. The driver samples sort keys for their bounds:
# a hundred for each, or fewer where that would be more than SAMPLED_KEYS in all.
ROWS_PER_PARTITION = 1_000_000
SAMPLED_KEYS = 1_000_000
FEWEST_SAMPLED = 4

# A helper table is broadcast only if its known number of rows, at the width of its
# columns, stays below this; beyond it the join is left to the planner.
BROADCAST_BYTES = 32_000_000
# Bytes taken for a value: fixed widths as in a row, a long text for anything else.
WIDTHS = {"boolean": 8, "tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "float": 8, "double": 8, "date": 8, "timestamp": 8, "timestamp_ntz": 8}
OTHER_WIDTH = 128

_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below bit 33


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys of two aliased tables."""
    terms = [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def row_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def partitions_for(rows: int) -> int:
    return max(math.ceil(rows / ROWS_PER_PARTITION), 1)


def size_of(at_most: DataFrame | int) -> int:
    return at_most if isinstance(at_most, int) else at_most.count()


def fitting(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, marked for broadcast if that is a bound on its bytes too."""
    width = sum(WIDTHS.get(kind, OTHER_WIDTH) for _, kind in df.dtypes)
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


@dataclass(frozen=True)
class Hot:
    """Large keys: a table of them, their number, and their rows in all."""

    keys: DataFrame
    groups: int
    rows: int


def find_hot(
    df: DataFrame,
    keys: Sequence[str],
    hot_rows: int,
    counts: DataFrame | None = None,
    at_most: DataFrame | int | None = None,
) -> Hot | None:
    """Keys with more than ``hot_rows`` rows, None if there are none.

    ``at_most`` is a bound on the rows of ``df``, or a table with no fewer rows
    that is cheap to count, such as the scan below it: if it is small no key can
    be hot, and nothing else is read. ``counts`` (keys and ``_n``) saves
    counting the rows of ``df`` per key.
    """
    if at_most is not None and size_of(at_most) <= hot_rows:
        return None
    counted = row_counts(df, keys) if counts is None else counts
    listed = materialise(counted.filter(F.col("_n") > hot_rows).select(*keys, "_n"), "hot")
    size = listed.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows")).first()
    return Hot(listed.drop("_n"), size["groups"], size["rows"]) if size["groups"] else None


def split_hot(df: DataFrame, hot: Hot, keys: Sequence[str], store: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows).

    ``store`` evaluates ``df`` once and writes the two parts to separate
    folders, for a ``df`` that is costly to evaluate for each of them.
    """
    if store:
        flagged = hot.keys.withColumn("_hot", F.lit(1))
        joined = df.alias("l").join(fitting(flagged.alias("h"), hot.groups), same_keys("l", "h", keys), "left")
        parts = joined.select(*[F.col(f"l.`{c}`") for c in df.columns], F.coalesce("_hot", F.lit(0)).alias("_hot"))
        stored = materialise(parts, "parts", ["_hot"])
        return stored.filter("_hot = 1").drop("_hot"), stored.filter("_hot = 0").drop("_hot")
    left, right = df.alias("l"), fitting(hot.keys.alias("h"), hot.groups)
    on = same_keys("l", "h", keys)
    return left.join(right, on, "left_semi"), left.join(right, on, "left_anti")


def _spread(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], partitions: int) -> DataFrame:
    """Sorted range partitions, written once so that the bounds cannot change.

    ``_pid`` is the partition and ``_at`` the row number inside it, from 0.
    """
    order = [*[F.col(f"`{k}`").asc() for k in keys], *order_by]
    numbered = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    sampled = min(max(SAMPLED_KEYS // partitions, FEWEST_SAMPLED), 100)
    with setting(df.sparkSession, "spark.sql.execution.rangeExchange.sampleSizePerPartition", str(sampled)):
        stored = materialise(numbered, "sorted")
    return (
        stored.withColumn("_pid", F.shiftright("_mid", 33))
        .withColumn("_at", F.col("_mid").bitwiseAND(_IN_PARTITION))
        .drop("_mid")
    )


def _before(parts: DataFrame, keys: Sequence[str], amount: str) -> Column:
    """Sum of ``amount`` over the earlier partitions of the key.

    ``parts`` has one row per partition and hot key, so the window is small.
    """
    window = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


def _numbered(
    df: DataFrame, order_by: Sequence[Column], keys: Sequence[str], groups: int, name: str, partitions: int
) -> DataFrame:
    """``df`` with its row number, and ``_pid`` and ``_at`` of its range partition."""
    spread = _spread(df, keys, order_by, partitions)
    parts = spread.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    offsets = parts.withColumn("_offset", _before(parts, keys, "_n") - F.col("_first")).drop("_n", "_first")
    on = (F.col("s._pid") == F.col("o._pid")) & same_keys("s", "o", keys)
    # a key's partitions follow each other, so there are at most this many pairs
    joined = spread.alias("s").join(fitting(offsets.alias("o"), partitions + groups), on)
    return joined.select("s.*", (F.col("s._at") + F.col("o._offset") + 1).alias(name))


def positions(
    df: DataFrame,
    order_by: Sequence[Column],
    keys: Sequence[str] = (),
    groups: int = 1,
    name: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Exact row number 1..n over the whole table, or per key of ``groups`` large keys.

    ``order_by`` must be a total order for a repeatable result.
    """
    partitions = partitions or partitions_for(df.count())
    return _numbered(df, order_by, keys, groups, name, partitions).drop("_pid", "_at")


def prefix_sums(
    df: DataFrame,
    order_by: Sequence[Column],
    weight: str,
    keys: Sequence[str] = (),
    groups: int = 1,
    name: str = "cumulative",
    partitions: int | None = None,
) -> DataFrame:
    """Running sum of ``weight`` over the whole table, or per key of ``groups`` large keys."""
    partitions = partitions or partitions_for(df.count())
    spread = _spread(df, keys, order_by, partitions)
    parts = spread.groupBy("_pid", *keys).agg(F.sum(weight).alias("_w"))
    offsets = parts.withColumn("_offset", _before(parts, keys, "_w")).drop("_w")
    # a window group is one key inside one range partition
    local = Window.partitionBy("_pid", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = spread.withColumn("_local", F.sum(weight).over(local))
    on = (F.col("s._pid") == F.col("o._pid")) & same_keys("s", "o", keys)
    joined = summed.alias("s").join(fitting(offsets.alias("o"), partitions + groups), on)
    return joined.select(*[F.col(f"s.`{c}`") for c in df.columns], (F.col("s._local") + F.col("o._offset")).alias(name))


def prefix_maxima(
    df: DataFrame,
    order_by: Sequence[Column],
    value: str,
    keys: Sequence[str] = (),
    groups: int = 1,
    name: str = "reached",
    partitions: int | None = None,
) -> DataFrame:
    """Largest ``value`` of all rows before, over the whole table or per key of ``groups`` large keys; NULL at the first.

    ``order_by`` must be a total order up to equal values for a repeatable result.
    """
    partitions = partitions or partitions_for(df.count())
    spread = _spread(df, keys, order_by, partitions)
    parts = spread.groupBy("_pid", *keys).agg(F.max(value).alias("_m"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_offset", F.max("_m").over(earlier)).drop("_m")
    local = Window.partitionBy("_pid", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    topped = spread.withColumn("_local", F.max(value).over(local))
    on = (F.col("s._pid") == F.col("o._pid")) & same_keys("s", "o", keys)
    joined = topped.alias("s").join(fitting(offsets.alias("o"), partitions + groups), on)
    return joined.select(*[F.col(f"s.`{c}`") for c in df.columns], F.greatest("s._local", "o._offset").alias(name))


def global_rank_ntile(
    df: DataFrame,
    value: str,
    tie_break: str,
    tiles: int = 5,
    rank_name: str = "rank",
    tile_name: str = "tile",
    percentiles: Mapping[str, float] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``rank()`` and ``ntile(tiles)`` over the whole table by ``value`` descending.

    Rows of equal value share a rank; ``tie_break`` decides their order for the
    tiles. The first ``n % tiles`` tiles are one row longer. ``percentiles``
    adds exact percentiles of ``value`` over all rows, read off the same sort.
    """
    points = dict(percentiles or {})
    partitions = partitions or partitions_for(df.count())
    placed = _numbered(df, [F.col(value).desc(), F.col(tie_break).asc()], (), 1, "_pos", partitions)
    # a tie starts inside its partition, unless it is the partition's first value;
    # those values, at most one per partition, are looked up everywhere
    inside = placed.withColumn("_inside", F.min("_pos").over(Window.partitionBy("_pid", value)))
    edges = placed.filter(F.col("_at") == 0).select(value).distinct()
    reaching = placed.alias("p").join(fitting(edges.alias("e"), partitions), same_keys("p", "e", [value]), "left_semi")
    starts = reaching.groupBy(value).agg(F.min("_pos").alias("_start"))
    rank = F.coalesce(F.col("_start"), F.col("_inside"))

    total = placed.agg(F.count(F.lit(1)).alias("_total"), F.count(value).alias("_known"))
    if points:
        # descending, with NULLs last: the a-th smallest value is at _known - a
        wanted = {name: (F.col("_known") - 1) * F.lit(float(p)) for name, p in points.items()}
        at = lambda a: F.max(F.when(F.col("_pos") == F.col("_known") - a, F.col(value).cast("double")))
        ends = [at(edge(a)).alias(f"{end}_{n}") for n, a in wanted.items() for end, edge in (("_lo", F.floor), ("_hi", F.ceil))]
        found = placed.crossJoin(F.broadcast(total)).groupBy("_total", "_known").agg(*ends)
        total = found.select("_total", *[interpolate(a, F.col(f"_lo_{n}"), F.col(f"_hi_{n}")).alias(n) for n, a in wanted.items()])

    small = F.floor(F.col("_total") / tiles)
    longer = F.col("_total") % tiles
    in_longer = longer * (small + 1)
    tile = F.when(F.col("_pos") <= in_longer, F.ceil(F.col("_pos") / (small + 1))).otherwise(
        longer + F.ceil(F.try_divide(F.col("_pos") - in_longer, small))
    )
    joined = inside.alias("p").join(fitting(starts.alias("r"), partitions), same_keys("p", "r", [value]), "left")
    return joined.crossJoin(F.broadcast(total)).select(
        *[F.col(f"p.`{c}`") for c in df.columns], rank.alias(rank_name), tile.cast("int").alias(tile_name), *points
    )


def interpolate(at: Column, low: Column, high: Column) -> Column:
    """Value at position ``at`` between its neighbours, as Spark's percentile has it."""
    mixed = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
    return F.when((F.floor(at) == F.ceil(at)) | (low == high), low).otherwise(mixed)
