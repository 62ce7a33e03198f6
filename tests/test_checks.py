"""Every check with passing and failing data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.checks import rows as R, tables as C
from ledgerloom.checks.runner import Check, accepted_range_check, check, not_null_check, row_check, run_checks, unique_check


@pytest.fixture(scope="module")
def make(spark):
    return lambda schema, *data: spark.createDataFrame([d if isinstance(d, tuple) else (d,) for d in data], schema)


def test_accepted_range(make):
    df = make("id int", -1, 11, None)
    assert R.accepted_range(df, "id", -1, 11).count() == 0
    assert R.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert R.accepted_range(df, "id", -1, 11, inclusive=False).count() == 2
    assert R.accepted_range(df.filter("id <> -1"), "id", min_value=0).count() == 0
    assert R.accepted_range(df, "id").count() == 0


def test_at_least_one(make, rows):
    assert C.at_least_one(make("field string", "a"), "field").count() == 0
    assert C.at_least_one(make("field string", "a"), "field", ["field"]).count() == 0
    assert rows(C.at_least_one(make("field string", None), "field")) == [(0,)]
    assert C.at_least_one(make("field string", "a").limit(0), "field").count() == 1
    assert rows(C.at_least_one(make("g int, v int", (1, 1), (1, None), (2, None)), "v", ["g"])) == [(2, 0)]


def test_cardinality_equality(make, rows):
    a, b = make("same_name int", 1, 2, 3), make("same_name int, different_name int", (1, 2), (2, 3), (3, 1))
    assert C.cardinality_equality(a, "same_name", b, "same_name").count() == 0
    assert C.cardinality_equality(a, "same_name", b, "different_name").count() == 0
    c = make("x int", 1, 1, 2, None)
    assert rows(C.cardinality_equality(a, "same_name", c, "x")) == [(1, 1), (1, 2), (3, 1), (None, 1)]


def test_equal_rowcount(make, rows):
    a = make("field int", 1, 1, 2)
    assert rows(C.equal_rowcount(a, a)) == [(3, 3, 0)]
    assert rows(C.equal_rowcount(a, a, ["field"]), "diff_count") == [(0,), (0,)]
    b = make("field int", 1, 3)
    assert rows(C.equal_rowcount(a, b), "diff_count") == [(1,)]
    out = C.equal_rowcount(a, b, ["field"])
    assert rows(out) == [(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 1, None)]
    # a group on one side only adds nothing
    result = run_checks(a, [check(C.equal_rowcount, b, ["field"])]).first()
    assert (result.failures, result.status) == (1, "error")


def test_fewer_rows_than(make, rows):
    a, b = make("col_a int, field int", (1, 1), (1, 2), (1, 3)), make("col_a int, field int", (1, 1), (1, 2), (1, 3), (1, 4))
    assert rows(C.fewer_rows_than(a, b)) == [(3, 4, 0)]
    assert rows(C.fewer_rows_than(a, b, ["col_a"]), "row_count_delta") == [(0,)]
    assert rows(C.fewer_rows_than(a, a), "row_count_delta") == [(1,)]
    assert rows(C.fewer_rows_than(b, a), "row_count_delta") == [(1,)]
    assert rows(C.fewer_rows_than(b, a.limit(1)), "row_count_delta") == [(3,)]
    assert run_checks(a, [check(C.fewer_rows_than, b)]).first().status == "pass"


def test_equality(make, rows):
    a, b = make("x int, y string", (1, "a"), (1, "a"), (2, None)), make("x int, y string", (2, None), (1, "a"))
    assert C.equality(a, b).count() == 0
    assert rows(C.equality(a, b, exact=True)) == [("a_minus_b", 1, "a")]
    c = make("x int, y string", (1, "b"), (2, None), (4, "d"))
    assert rows(C.equality(a, c)) == [("a_minus_b", 1, "a"), ("b_minus_a", 1, "b"), ("b_minus_a", 4, "d")]
    assert rows(C.equality(a, c, ["x"])) == [("b_minus_a", 4)]
    # three rows, plus one for two against one
    assert run_checks(a, [check(C.equality, c)]).first().failures == 4


def test_expression_is_true(make):
    df = make("col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert R.expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert R.expression_is_true(df, "+ col_b = 1", "col_a").count() == 0
    assert R.expression_is_true(df.filter("col_a = 0.5"), "= 0.5", "col_b").count() == 0
    assert R.expression_is_true(df, "col_a = 0.5 or false").count() == 2


def test_not_accepted_and_accepted_values(make, rows):
    cities = make("id int, city string", (1, "Barcelona"), (2, "London"), (3, "Paris"), (4, "New York"), (5, "Paris"), (6, None))
    assert R.not_accepted_values(cities, "city", ["Madrid", "Berlin"]).count() == 0
    assert rows(R.not_accepted_values(cities, "city", ["Paris", "Berlin"])) == [("Paris",)]
    assert R.accepted_values(cities, "city", ["Barcelona", "London", "Paris", "New York"]).count() == 0
    assert rows(R.accepted_values(cities, "city", ["London", "New York"])) == [("Barcelona", 1), ("Paris", 2)]


def test_not_constant(make, rows):
    df = make("col_a int, field int", (1, 1), (1, 1), (1, 2))
    assert C.not_constant(df, "field").count() == 0
    assert C.not_constant(df, "field", ["col_a"]).count() == 0
    assert rows(C.not_constant(make("g int, f int", (1, 5), (1, 5), (2, None), (3, 1), (3, None)), "f", ["g"])) == [(1, 1), (3, 1)]


def test_not_empty_string(make):
    df = make("s string", "a", "   ", "", None)
    assert R.not_empty_string(df, "s").count() == 2
    assert R.not_empty_string(df, "s", trim_whitespace=False).count() == 1
    assert R.not_empty_string(df.filter("s = 'a' or s is null"), "s").count() == 0


def test_not_null_proportion(make, rows):
    five, nine = [1, None, None, 4, 5, 6, None, None, None, 10], [1, 2, 3, 4, 5, 6, 7, 8, None, 10]
    df = make("point_5 int, point_9 int", *zip(five, nine))
    assert C.not_null_proportion(df, "point_5", 0.5, 0.5).count() == 0
    assert C.not_null_proportion(df, "point_9", 0.9).count() == 0
    assert C.not_null_proportion(df, "point_5", 0, group_by=["point_9"]).count() == 0
    assert rows(C.not_null_proportion(df, "point_5", 0.6)) == [(0.5,)]
    assert C.not_null_proportion(df, "point_9", 0.1, 0.8).count() == 1


def test_recency(make):
    now = dt.datetime(2024, 5, 2, 12)
    df = make("col1 int, col2 int, created_at timestamp", (1, 1, now - dt.timedelta(hours=23)))
    for group in ([], ["col1"], ["col1", "col2"]):
        assert C.recency(df, "created_at", "day", 1, group_by=group, as_of=now).count() == 0
    yesterday = make("created_at timestamp", dt.datetime(2024, 5, 1))
    assert C.recency(yesterday, "created_at", "day", 1, ignore_time_component=True, as_of=now).count() == 0
    assert C.recency(yesterday, "created_at", "day", 1, as_of=now).count() == 1
    assert C.recency(df.limit(0), "created_at", "day", 1, as_of=now).count() == 0
    inverted = check(C.recency, "created_at", "day", 1, as_of=now, error_if="<1", warn_if="<0")
    assert run_checks(yesterday, [inverted]).first().status == "pass"
    assert run_checks(df, [inverted]).first().status == "error"


def test_relationships_where(make, rows):
    one, two = make("id int", 1, 2, 3), make("id int", 1, 2, 4, 4, None)
    assert C.relationships_where(two, "id", one, "id", "id <> 4").count() == 0
    assert rows(C.relationships_where(two, "id", one, "id")) == [(4, None), (4, None)]
    assert rows(C.relationships_where(one, "id", two, "id", to_condition="id > 1")) == [(1, None), (3, None)]


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_sequential_values(make, rows, hot_rows):
    even = make("col_a int, my_even_sequence int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    go = lambda df, *a, **k: C.sequential_values(df, *a, hot_rows=hot_rows, partitions=3, **k)
    assert go(even, "my_even_sequence", 2).count() == 0
    assert go(even, "my_even_sequence", 2, group_by=["col_a"]).count() == 0
    assert go(even, "my_even_sequence", 1).count() == 4
    assert rows(go(make("v int", 1, 2, 2, 5), "v")) == [(2, 2), (5, 2)]
    hours = make("my_timestamp timestamp", *[dt.datetime(2021, 1, 1, h) for h in range(4)])
    assert go(hours, "my_timestamp", 1, "hour").count() == 0
    assert go(hours, "my_timestamp", 1, "day").count() == 3


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_mutually_exclusive_ranges(make, rows, hot_rows):
    go = lambda df, *a, **k: C.mutually_exclusive_ranges(df, *a, hot_rows=hot_rows, **k)
    tight = make("lower_bound int, upper_bound int", (0, 1), (1, 2), (2, 4))
    assert go(tight, "lower_bound", "upper_bound", gaps="not_allowed").count() == 0
    assert go(tight, "lower_bound", "upper_bound").count() == 0
    assert go(tight, "lower_bound", "upper_bound", gaps="required").count() == 2
    day = dt.date.fromisoformat
    spans = [(1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"), (2, "2019-05-06", "2019-07-02"), (2, "2019-07-03", None)]
    gaps = make("subscription_id int, valid_from date, valid_to date", *[(i, day(a), day(b) if b else None) for i, a, b in spans])
    end = F.coalesce("valid_to", F.lit("2099-01-01").cast("date"))
    for kind in ("allowed", "required"):
        assert go(gaps, "valid_from", end, "subscription_id", gaps=kind).count() == 0
    assert go(gaps, "valid_from", end, "subscription_id", gaps="not_allowed").count() == 2
    assert go(gaps, "valid_from", "valid_to", "subscription_id").count() == 1  # an open end
    zero = [
        (3, "2020-05-06", "2020-05-07"), (3, "2020-05-08", "2020-05-10"), (3, "2020-05-08", "2020-05-08"), (3, "2020-05-12", "2020-05-15"),
        (4, "2020-06-06", "2020-06-07"), (4, "2020-06-08", "2020-06-08"), (4, "2020-06-09", "2020-06-10"),
    ]
    spans = make("subscription_id int, valid_from date, valid_to date", *[(i, day(a), day(b)) for i, a, b in zero])
    assert go(spans, "valid_from", "valid_to", "subscription_id", zero_length_range_allowed=True).count() == 0
    assert go(spans, "valid_from", "valid_to", "subscription_id").count() == 2
    for bad in ({"gaps": "maybe"}, {"zero_length_range_allowed": "no"}):
        with pytest.raises(ValueError):
            go(tight, "lower_bound", "upper_bound", **bad)


def test_unique_checks(make, rows):
    sold = [("2019-01-01", "jaffle"), ("2019-01-01", "lamington"), ("2019-02-01", "jaffle"), ("2019-02-01", None)]
    df = make("month string, product string", *sold)
    assert C.unique_combination_of_columns(df, ["month", "product"]).count() == 0
    again = df.unionAll(df.filter("product is null"))
    assert rows(C.unique_combination_of_columns(again, ["month", "product"])) == [("2019-02-01", None)]
    assert rows(C.unique(again, "product")) == [("jaffle", 2)]
    assert R.not_null(again, "product").count() == 2


def test_assert_equal_and_columns(make, rows):
    assert rows(R.assert_equal(make("a int, b int", (1, 1), (1, 2), (None, 3)), "a", "b")) == [(1, 2)]
    df = make("id int, name string", (1, "a"))
    assert C.columns_match_set(df, ["ID", "name"]).count() == 0
    assert rows(C.columns_match_set(df, ["id", "colour"])) == [("NAME", None), (None, "COLOUR")]


def test_runner_thresholds_filters_and_severity(make):
    df = make("id int, v int", (1, 5), (2, None), (3, 50), (3, 60))
    suite = [
        not_null_check("v"),
        not_null_check("v", where="id <> 2"),
        accepted_range_check("v", 0, 40, severity="warn"),
        row_check("large", F.col("v") > 40, error_if=">5", warn_if=">1"),
        unique_check("id"),
        unique_check("id", error_if=">1"),
        check(C.unique, "id", name="unique_small", where="id < 3"),
    ]
    got = [(r.check_name, r.failures, r.status) for r in run_checks(df, suite, "t").collect()]
    assert sorted(got) == sorted(
        [
            ("not_null_v", 1, "error"),
            ("not_null_v", 0, "pass"),
            ("accepted_range_v", 2, "warn"),
            ("large", 2, "warn"),
            ("unique_id", 1, "error"),
            ("unique_id", 1, "warn"),
            ("unique_small", 0, "pass"),
        ]
    )


def test_runner_rejects_bad_specs():
    with pytest.raises(ValueError):
        Check("nothing")
    with pytest.raises(ValueError):
        Check("bad", violations=lambda df: df, error_if="> 1; drop")
    with pytest.raises(ValueError):
        Check("bad", violations=lambda df: df, severity="fatal")


@pytest.mark.parametrize("hot_rows", [10**6, 40, 1])
@pytest.mark.parametrize("keyed", [True, False])
def test_overlapping_ranges_equal_brute_force(spark, rows, hot_rows, keyed):
    rng = random.Random(hot_rows)
    data = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, *range(200)]), rng.choice([None, *range(260)])) for _ in range(300)]
    data += [(1, 10, 190), (1, 10, 190), (2, 5, 5)]
    got = C.overlapping_ranges(spark.createDataFrame(data, "k int, lo int, hi int"), "lo", "hi", "k" if keyed else None, hot_rows, partitions=7)
    want = []
    for key in {k for k, _, _ in data} if keyed else {0}:
        top = None
        for lo, hi in sorted((lo, hi) for k, lo, hi in data if (k == key or not keyed) and lo is not None and hi is not None and lo < hi):
            if top is not None and lo < top:
                want.append(((key,) if keyed else ()) + (lo, hi, top))
            top = hi if top is None else max(top, hi)
    assert rows(got) == sorted(want, key=repr) and want


def test_a_range_inside_an_earlier_one_is_found(spark, rows):
    nested = spark.createDataFrame([(1, 100), (2, 3), (50, 60), (100, 101)], "lo int, hi int")
    assert rows(C.overlapping_ranges(nested, "lo", "hi")) == [(2, 3, 100), (50, 60, 100)]
    assert C.overlapping_ranges(nested.limit(0), "lo", "hi").count() == 0
