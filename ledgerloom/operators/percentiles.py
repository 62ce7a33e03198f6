"""Exact continuous percentiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise, scratch_dir
from .ordered import HOT_ROWS, Hot, find_hot, fitting, interpolate, same_keys, size_of, split_hot

Targets = Mapping[str, tuple[str, float]]

# Spark's percentile holds the distinct values of many groups of a task at once,
# so groups stay smaller here than for windows, which see one group at a time.
GROUP_ROWS = 200_000
BINS = 1 << 16  # of each pass of the radix selection


def _bounded(
    df: DataFrame, keys: Sequence[str], targets: Targets, aggregates: Mapping[str, Column] | None = None, weight: str | None = None
) -> DataFrame:
    """Spark's own percentile: a group's distinct values in one buffer."""
    by_column: dict[str, list[tuple[str, float]]] = {}
    for name, (c, p) in targets.items():
        by_column.setdefault(c, []).append((name, p))
    arrays = [
        F.percentile(F.col(c).cast("double"), F.array(*[F.lit(p) for _, p in wanted]), F.col(weight) if weight else F.lit(1)).alias(f"_{i}")
        for i, (c, wanted) in enumerate(by_column.items())
    ]
    place = {name: (i, j) for i, wanted in enumerate(by_column.values()) for j, (name, _) in enumerate(wanted)}
    plain = dict(aggregates or {})
    found = df.groupBy(*keys).agg(*[a.alias(n) for n, a in plain.items()], *arrays)
    return found.select(*keys, *plain, *[F.col(f"_{i}")[j].alias(n) for n in targets for i, j in [place[n]]])


def _narrowed(df: DataFrame, keys: Sequence[str], groups: int, targets: Targets, weight: str | None = None) -> DataFrame:
    """Radix selection: the range that holds a wanted rank is cut into ``BINS`` bins, counted, and narrowed to one of them.

    Every pass counts in the tasks before the shuffle, at most a row for each bin, and keeps for each rank the least and
    greatest value of its bin; it ends when they are equal. Nothing is sorted, and nothing but the ranks is
    written. Doubles need two or three passes; an interval always splits, since its ends fall into different bins.
    """
    columns = list(dict.fromkeys(c for c, _ in targets.values()))
    measures = F.array(*[F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    times = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    cells = df.select(*keys, times.alias("_w"), F.explode(measures).alias("_c")).select(*keys, "_w", F.col("_c.m").alias("_m"), F.col("_c.v").alias("_v"))
    cells, group = cells.filter(F.col("_v").isNotNull()), [*keys, "_m"]
    value, endless = F.col("_v"), F.lit(float("inf"))
    finite = ~F.isnan(value) & (F.abs(value) < endless)
    rows_where = lambda told: F.sum(F.when(told, F.col("_w")).otherwise(F.lit(0).cast("bigint")))
    sums = cells.groupBy(*group).agg(
        F.sum("_w").alias("_total"), rows_where(value == -endless).alias("_below"), rows_where(finite).alias("_finite"), rows_where(value == endless).alias("_above"), F.min(F.when(finite, value)).alias("_lo"), F.max(F.when(finite, value)).alias("_hi"),
    )

    def sides(i: int, c: str, p: float) -> list[Column]:
        at = (F.col("_total") - 1) * F.lit(float(p))
        return [F.struct(F.lit(columns.index(c)).alias("c"), F.lit(i).alias("i"), F.lit(side).alias("side"), at.alias("at"), to(at).alias("rank")) for side, to in (("lo", F.floor), ("hi", F.ceil))]

    asked = F.explode(F.array(*[x for i, (c, p) in enumerate(targets.values()) for x in sides(i, c, p)]))
    ranks = sums.select("*", asked.alias("_t")).select("*", "_t.i", "_t.side", "_t.at", "_t.rank").filter(F.col("_t.c") == F.col("_m"))
    # doubles that are no numbers have their places at both ends
    fixed = F.when(F.col("rank") < F.col("_below"), -endless).when(F.col("rank") >= F.col("_below") + F.col("_finite"), F.when(
        F.col("rank") < F.col("_below") + F.col("_finite") + F.col("_above"), endless).otherwise(F.lit(float("nan"))))
    held = [*group, "i", "side", "at", "rank", "_below"]
    state = materialise(ranks.select(*held, F.coalesce(fixed, "_lo").alias("_lo"), F.coalesce(fixed, "_hi").alias("_hi")), "ranks")
    asked_for = groups * 2 * len(targets)

    while not (unknown := state.filter(F.col("_lo") < F.col("_hi"))).isEmpty():
        interval = [*group, "_lo", "_hi"]
        left, right = cells.alias("c"), fitting(unknown.select(*interval).distinct().alias("r"), asked_for)
        inside = left.join(right, same_keys("c", "r", group) & F.col("c._v").between(F.col("r._lo"), F.col("r._hi")))
        width = F.col("_hi") - F.col("_lo")
        share = F.when(width < endless, (value - F.col("_lo")) / width).otherwise((value / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2))
        binned = inside.select(*[F.col(f"r.`{k}`") for k in interval], "c._v", "c._w").withColumn("_bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        counted = binned.groupBy(*interval, "_bin").agg(F.sum("_w").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        upto = F.sum("_n").over(Window.partitionBy(*interval).orderBy("_bin"))  # BINS rows at most
        counted = counted.withColumn("_before", upto - F.col("_n")).alias("b")
        here = (F.col("u.rank") - F.col("u._below")).between(F.col("b._before"), F.col("b._before") + F.col("b._n") - 1)
        found = fitting(unknown.alias("u"), asked_for).join(counted, same_keys("u", "b", interval) & here)
        found = found.select(*[F.col(f"u.`{c}`") for c in held[:-1]], (F.col("u._below") + F.col("b._before")).alias("_below"), F.col("b._least").alias("_lo"), F.col("b._most").alias("_hi"))
        state = materialise(state.filter(~(F.col("_lo") < F.col("_hi"))).unionByName(found), "ranks")

    one = lambda i, side, c: F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col(c)))
    found = state.groupBy(*keys).agg(*[one(i, s, c).alias(f"{n}{i}") for i in range(len(targets)) for n, s, c in (("_l", "lo", "_lo"), ("_h", "hi", "_lo"), ("_at", "lo", "at"))])
    between = lambda i: interpolate(F.col(f"_at{i}"), F.col(f"_l{i}"), F.col(f"_h{i}"))
    return found.select(*keys, *[between(i).alias(name) for i, name in enumerate(targets)])


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    targets: Targets,
    aggregates: Mapping[str, Column] | None = None,
    counts: DataFrame | None = None,
    at_most: DataFrame | int | None = None,
    hot_rows: int | None = None,
    store: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """``targets`` maps a result column to (column, fraction); one row per key.

    Groups of at most ``hot_rows`` rows use the built-in aggregate; larger ones
    are found by radix selection. The values are the same: linear interpolation between neighbours, NULLs ignored, double.
    ``aggregates`` maps further result columns to plain aggregates, taken in the
    same pass where possible. ``counts`` and ``at_most`` as in ``find_hot``.
    ``store`` evaluates ``df`` once if there are large groups: for a ``df`` of
    joins, cut to the columns needed.
    ``hot_rows`` is ``GROUP_ROWS`` for keyed groups and ``HOT_ROWS`` for the
    whole table unless given. ``weight`` names a column of whole numbers above 0: how many equal rows a row
    stands for; ``aggregates`` count rows as they are.
    """
    extra = dict(aggregates or {})
    scratch_dir(df.sparkSession)  # wanted at every size, so that a growing group changes no requirement
    if not keys:
        size = size_of(df if at_most is None else at_most)
        if size <= (HOT_ROWS if hot_rows is None else hot_rows):
            return _bounded(df, [], targets, extra, weight)
        marks = _narrowed(df, [], 1, targets, weight)
        return df.agg(*[a.alias(n) for n, a in extra.items()]).crossJoin(F.broadcast(marks)) if extra else marks
    large = find_hot(df, keys, GROUP_ROWS if hot_rows is None else hot_rows, counts, at_most)
    if large is None:
        return _bounded(df, keys, targets, extra, weight)
    hot, cold = split_hot(df, large, keys, store)
    found = large_percentiles(hot, large, keys, targets, weight)
    if extra:
        sums = hot.groupBy(*keys).agg(*[a.alias(n) for n, a in extra.items()])
        joined = sums.alias("a").join(fitting(found.alias("p"), large.groups), same_keys("a", "p", keys))
        found = joined.select("a.*", *[F.col(f"p.`{n}`") for n in targets])
    return _bounded(cold, keys, targets, extra, weight).unionByName(found)


def large_percentiles(rows: DataFrame, hot: Hot, keys: Sequence[str], targets: Targets, weight: str | None = None) -> DataFrame:
    """Percentiles of the large groups, those holding no value at all included."""
    found = _narrowed(rows, keys, hot.groups, targets, weight)
    joined = hot.keys.alias("k").join(found.alias("f"), same_keys("k", "f", keys), "left")
    return joined.select(*[F.col(f"k.`{k}`") for k in keys], *[F.col(f"f.`{n}`") for n in targets])
