"""SQL functions against the column functions and generators of the same meaning."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import casts, expressions as E, sql
from ledgerloom.operators.generators import PARTS, date_spine


@pytest.fixture(scope="module")
def session(spark):
    names = sql.register(spark)
    assert sql.register(spark) == names == [*sql.SCALAR, *sql.TABLE]  # again replaces
    return spark


URLS = [None, "", "http://a.b/c/d?x=1&y=2", "https://a.b?x=1", "android-app://p.q/r", "a.b", "http://a.b/c?y=&x=3", "/p?q", "?x=9"]
TEXTS = [None, "", "ab", "abcdefgh", "12.345", "1e3", "x", "2024-02-30", "2024-02-29 10:00:00", "99999999999999999", "äöü€uro"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mask_pii(t)", lambda: E.mask_pii("t")),
        ("safe_decimal(t)", lambda: casts.safe_decimal("t")),
        ("safe_timestamp(t)", lambda: casts.safe_timestamp("t")),
        ("hash_column(t)", lambda: E.hash_column("t")),
        ("url_host(t)", lambda: E.url_host("t")),
        ("url_path(t)", lambda: E.url_path("t")),
        ("url_parameter(t, 'x')", lambda: E.url_parameter("t", "x")),
        ("surrogate_key(array(t, u))", lambda: E.surrogate_key(["t", "u"])),
        ("business_key(array(t, u))", lambda: E.business_key(["t", "u"])),
        ("age_years(try_cast(t AS DATE), TIMESTAMP '2025-03-01')", lambda: casts.age_years(F.col("t").try_cast("date"), "2025-03-01")),
    ],
)
def test_texts(session, text, expected):
    df = session.createDataFrame([(t, u) for t in [*URLS, *TEXTS] for u in (None, "v")], "t string, u string")
    found = df.select("t", F.expr(text).alias("got"), expected().alias("want")).collect()
    assert [(r["t"], r["got"]) for r in found] == [(r["t"], r["want"]) for r in found]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("haversine_miles(a, b, c, d)", lambda: E.haversine_distance("a", "b", "c", "d")),
        ("haversine_km(a, b, c, d)", lambda: E.haversine_distance("a", "b", "c", "d", "km")),
        ("safe_divide(a, b)", lambda: E.safe_divide("a", "b")),
        ("safe_add(array(a, b, c))", lambda: E.safe_add(["a", "b", "c"])),
    ],
)
def test_numbers(session, text, expected):
    points = [(0.0, 0.0, 0.0, 0.0), (48.8, 2.3, 40.7, -74.0), (0.0, 0.0, 0.0, 180.0), (90.0, 1.0, -90.0, 5.0), (1.5, None, 2.0, 3.0)]
    found = session.createDataFrame(points, "a double, b double, c double, d double").select(F.expr(text).alias("got"), expected().alias("want")).collect()
    for row in found:
        assert row["got"] == (None if row["want"] is None else pytest.approx(row["want"], rel=1e-12, abs=1e-12))


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("first, last", [("2023-12-31 22:00:00", "2024-01-01 01:30:00"), ("2024-01-31", "2024-04-02"), ("2024-02-01", "2024-01-01"), ("2024-01-01", "2024-01-01")])
def test_spines(session, part, first, last):
    got = session.sql(f"SELECT * FROM date_spine_{part}(TIMESTAMP '{first}', TIMESTAMP '{last}')")
    want = date_spine(session, part, first, last)
    assert got.dtypes == want.dtypes
    if part == "second" and last == "2024-04-02":  # millions of rows: how many, and the ends
        ends = lambda df: df.agg(F.count("*"), F.min(df.columns[0]), F.max(df.columns[0])).first()
        assert ends(got) == ends(want)
    else:
        assert sorted(got.collect()) == sorted(want.collect())


def test_series(session):
    assert [r[0] for r in session.sql("SELECT * FROM generated_series(10000) ORDER BY 1").collect()] == list(range(1, 10001))
    assert session.sql("SELECT * FROM generated_series(0)").count() == 0


def test_bodies_are_part_of_the_plan(session):
    plan = session.createDataFrame([("a",)], "t string").select(F.expr("mask_pii(t)"))._jdf.queryExecution().optimizedPlan().toString()
    assert "********" in plan and "mask_pii" not in plan.split("AS")[0]
