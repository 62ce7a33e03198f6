"""Equality by checksums gives the rows of the plain comparison, and exchanges few rows of tables that are mostly equal."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.checks import checksums, tables


def bag(df):
    # both zeros are written alike
    return Counter(tuple(str(v + 0.0 if isinstance(v, float) else v) for v in r) for r in df.collect())


SCHEMA = "i int, d double, s string, c decimal(20,3), b binary, t timestamp"


@pytest.fixture(scope="module")
def drawn(spark):
    """Two tables with NULLs, repeats and few differences."""
    rng = random.Random(7)
    one = lambda: (
        rng.choice([None, rng.randint(0, 30)]), rng.choice([None, 0.0, -0.0, math.nan, math.inf, rng.random()]), rng.choice([None, "", "a", "ab"]),
        None, rng.choice([None, b"", b"x"]), None,
    )
    rows = [one() for _ in range(800)]
    other = rows[5:] + rows[40:60] + [one() for _ in range(7)]
    rng.shuffle(other)
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)


@pytest.mark.parametrize("exact", [False, True])
def test_same_rows_as_the_plain_comparison(drawn, exact):
    a, b = drawn
    assert bag(checksums.equality(a, b, exact=exact)) == bag(tables.equality(a, b, exact=exact))


def test_a_row_that_occurs_oftener_differs_only_as_a_bag(spark):
    a = spark.range(500).select((F.col("id") % 50).alias("k"))
    b = a.unionAll(a.filter("k = 7").limit(1))
    assert checksums.equality(a, b).count() == 0
    assert bag(checksums.equality(a, b, exact=True)) == {("b_minus_a", "7"): 1}
    assert bag(checksums.cardinality_equality(a, "k", b.withColumnRenamed("k", "j"), "j")) == {("7", "10"): 1, ("7", "11"): 1}


def test_nulls_in_other_columns_are_other_rows(spark):
    a, b = spark.createDataFrame([(None, 1)], "x int, y int"), spark.createDataFrame([(1, None)], "x int, y int")
    assert checksums.equality(a, b).count() == 2


def test_zeros_and_nans_of_any_kind_are_equal(spark):
    a, b = (spark.createDataFrame([(z,), (math.nan,)], "x double") for z in (0.0, -0.0))
    assert checksums.differing_rows(a, b)[0].count() == 0 and checksums.equality(a, b).count() == 0


def test_types_are_made_alike(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x bigint")
    assert bag(checksums.equality(a, b)) == {("a_minus_b", "2"): 1, ("b_minus_a", "3"): 1}


def test_nested_columns_are_compared_as_rows(spark):
    a, b = spark.createDataFrame([([1, None],)], "x array<int>"), spark.createDataFrame([([None, 1],)], "x array<int>")
    assert checksums.equality(a, b).count() == 2


def test_empty_tables(spark):
    a = spark.createDataFrame([], "x int")
    assert checksums.equality(a, a).count() == 0
    assert bag(checksums.equality(a, spark.createDataFrame([(None,)], "x int"))) == {("b_minus_a", "None"): 1}


def test_few_rows_are_left_of_tables_that_are_mostly_equal(spark):
    a = spark.range(200_000).select("id", (F.col("id") * 3).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))
    left, right = checksums.differing_rows(a, b)
    assert left.columns == a.columns and {77} <= {r["id"] for r in left.collect()}
    assert left.count() < 50 and right.count() < 50  # 65,536 buckets, two of them differ
