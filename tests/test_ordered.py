"""Split forms against plain windows and brute force, hot keys included."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from ledgerloom.functions.windows import rolling_mean, running_sum
from ledgerloom.operators.keyed import keyed_windows
from ledgerloom.operators.ordered import global_rank_ntile, positions, prefix_sums
from ledgerloom.operators.percentiles import exact_percentiles


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one key, a third to NULL; times are tied."""
    random.seed(7)
    data = []
    for i in range(900):
        key = [1, None, random.randint(2, 40)][i % 3]
        amount = None if random.random() < 0.05 else random.randint(0, 30)
        data.append((i, key, random.randint(0, 50), amount))
    df = spark.createDataFrame(data, "id long, k int, t int, v int")
    return df.withColumn("amount", (F.col("v") / 4).cast("decimal(15,2)")).drop("v").repartition(5).cache()


ORDER = ["t", "id"]


def windows(df, hot_rows, partitions=None, keys=("k",)):
    return keyed_windows(
        df,
        list(keys),
        [F.col(c).asc() for c in ORDER],
        framed={
            "near": lambda w: rolling_mean("amount", w, 7),
            "far": lambda w: rolling_mean("amount", w, 30),
            "before": lambda w: F.lag("t").over(w),
        },
        running={"total": "amount", "ids": "id"},
        totals={"n": F.count(F.lit(1)), "mean": F.avg("amount"), "first": F.min("t")},
        percentiles={"mid": ("amount", 0.5), "high": ("amount", 0.9)},
        rows_back=30,
        hot_rows=hot_rows,
        partitions=partitions,
    )


@pytest.mark.parametrize("hot_rows, partitions", [(1, 7), (31, 3), (50, 6), (250, 2), (299, None)])
def test_split_keys_equal_plain_windows(skewed, rows, hot_rows, partitions):
    plain = windows(skewed, 10_000)
    split = windows(skewed, hot_rows, partitions)
    assert split.schema.simpleString() == plain.schema.simpleString()
    assert rows(split) == rows(plain)


def test_plain_form_is_spark_windows(skewed, rows):
    w = Window.partitionBy("k").orderBy("t", "id")
    got = windows(skewed, 10_000).select("id", "near", "total", "before", "n")
    want = skewed.select(
        "id", rolling_mean("amount", w, 7), running_sum("amount", w), F.lag("t").over(w), F.count(F.lit(1)).over(Window.partitionBy("k"))
    )
    assert rows(got) == rows(want)


@pytest.mark.parametrize("hot_rows", [40, 10_000])
def test_without_keys_the_table_is_one_group(skewed, rows, hot_rows):
    w = Window.orderBy("t", "id")
    got = windows(skewed, hot_rows, 4, keys=()).select("id", "far", "total", "before", "n")
    want = skewed.select("id", rolling_mean("amount", w, 30), running_sum("amount", w), F.lag("t").over(w), F.lit(900))
    assert rows(got) == rows(want)


def test_small_table_skips_the_count(skewed):
    broken = skewed.filter(F.raise_error(F.lit("counted")).isNull())  # must not be evaluated
    out = keyed_windows(skewed, ["k"], [F.col("id").asc()], running={"s": "t"}, at_most=900, counts=broken)
    assert out.count() == 900


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_positions_and_prefix_sums(skewed, rows, partitions):
    w = Window.orderBy(F.col("t").desc(), "id")
    got = positions(skewed.select("t", "id"), [F.col("t").desc(), F.col("id").asc()], partitions=partitions)
    assert rows(got) == rows(skewed.select("t", "id", F.row_number().over(w)))
    summed = prefix_sums(skewed.select("t", "id"), [F.col("t").desc(), F.col("id").asc()], "t", partitions=partitions)
    assert rows(summed) == rows(skewed.select("t", "id", F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, 0))))


@pytest.mark.parametrize("tiles", [1, 4, 5, 7, 1000])
@pytest.mark.parametrize("value", ["t", "amount", "one"])
def test_rank_and_ntile_equal_plain_windows(skewed, rows, tiles, value):
    df = skewed.withColumn("one", F.lit(1)).select("id", value)
    w = Window.orderBy(F.col(value).desc())
    want = df.select("id", value, F.rank().over(w), F.ntile(tiles).over(Window.orderBy(F.col(value).desc(), "id")))
    assert rows(global_rank_ntile(df, value, "id", tiles, partitions=6)) == rows(want)


@pytest.mark.parametrize("partitions", [1, 6])
def test_rank_ntile_percentiles_ignore_nulls(skewed, partitions):
    got = global_rank_ntile(skewed.select("id", "amount"), "amount", "id", percentiles={"p9": 0.9, "p0": 0.0, "p1": 1.0}, partitions=partitions)
    want = skewed.agg(*[F.percentile("amount", F.lit(p)) for p in (0.9, 0.0, 1.0)]).first()
    assert [tuple(r) for r in got.select("p9", "p0", "p1").distinct().collect()] == [pytest.approx(tuple(want))]


@pytest.mark.parametrize("hot_rows", [20, 299, 10_000])
@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles_equal_built_in(skewed, rows, hot_rows, keys):
    points = {"p0": ("amount", 0.0), "p50": ("amount", 0.5), "p95": ("amount", 0.95), "p100": ("amount", 1.0), "t25": ("t", 0.25)}
    more = {"n": F.count(F.lit(1)), "d": F.count_distinct("t")}
    got = exact_percentiles(skewed, keys, points, aggregates=more, hot_rows=hot_rows)
    want = skewed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("t").alias("d"), *[F.percentile(c, F.lit(p)).alias(n) for n, (c, p) in points.items()]
    )
    near = lambda df: rows(df.select(*keys, "n", "d", *[F.round(n, 9) for n in points]))
    assert near(got) == near(want)


def test_percentiles_of_a_large_group_without_values(spark, rows):
    df = spark.createDataFrame([(1, None)] * 5 + [(2, 4)] * 5, "k int, v int")
    assert rows(exact_percentiles(df, ["k"], {"m": ("v", 0.5)}, hot_rows=2)) == [(1, None), (2, 4.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5) | st.none(), min_size=1, max_size=40), p=st.sampled_from([0.0, 0.1, 0.5, 0.75, 0.99, 1.0]))
def test_percentile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = exact_percentiles(df, [], {"x": ("v", p)}, hot_rows=0).collect()
    known = sorted(v for v in values if v is not None)
    if not known:
        assert [r.x for r in got] in ([], [None])
        return
    at = p * (len(known) - 1)
    low, high = known[int(at)], known[min(int(at) + 1, len(known) - 1)]
    assert got[0].x == pytest.approx(low + (at - int(at)) * (high - low))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(width=64) | st.sampled_from([5e-324, 1.7e308, -1.7e308, 0.1, 0.2]), min_size=1, max_size=30), bins=st.sampled_from([2, 16]))
def test_narrowing_finds_any_doubles(spark, values, bins):
    """Infinities, NaN, the smallest and the largest numbers; the ranks asked for are whole, so nothing is interpolated."""
    from ledgerloom.operators import percentiles

    points = {f"p{i}": ("v", i / max(len(values) - 1, 1)) for i in {0, len(values) - 1}}
    df = spark.createDataFrame([(k, v) for v in values for k in (1, 2)], "k int, v double")
    before, percentiles.BINS = percentiles.BINS, bins
    try:
        got = exact_percentiles(df, ["k"], points, hot_rows=0).collect()
    finally:
        percentiles.BINS = before
    ordered = sorted(values, key=lambda v: (v != v, v))
    for row in got:
        for name, at in {"p0": 0, f"p{len(values) - 1}": len(values) - 1}.items():
            assert row[name] == ordered[at] or (row[name] != row[name] and ordered[at] != ordered[at])
