"""Scalar expressions against golden rows."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import casts, expressions as E
from ledgerloom.operators import projection


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_surrogate_key_golden(spark):
    # fixed values: hashes of the golden seed
    data = [
        ("a", "b", "c", "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("a", None, "c", "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        (None, None, "c", "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        (None, None, None, "f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]
    df = spark.createDataFrame(data, "a string, b string, c string, first string, all string")
    bad = df.filter((E.surrogate_key(["a"]) != F.col("first")) | (E.surrogate_key(["a", "b", "c"]) != F.col("all")))
    assert bad.count() == 0


def test_surrogate_key_nulls_as_empty(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x")], "a string, b string")
    keys = df.select(E.surrogate_key(["a", "b"], null_as_empty=True).alias("k")).distinct()
    assert keys.count() == 1
    assert df.select(E.surrogate_key(["a", "b"]).alias("k")).distinct().count() == 2


def test_business_key_is_null_with_any_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(E.business_key(["a", "b"])).collect()] == ["a~b", None]


@pytest.mark.parametrize(
    "value, masked",
    [("someone@bank.example", "som********mple"), ("abcdefg", "abc********defg"), ("ab", "ab********ab"), (None, None)],
)
def test_mask_pii(spark, value, masked):
    assert one(spark, E.mask_pii(F.lit(value).cast("string"))) == masked


def test_mask_pii_hides_short_values_on_request(spark):
    assert one(spark, E.mask_pii(F.lit("ab"), min_hidden=1)) == "********"
    assert one(spark, E.mask_pii(F.lit("abcdefgh"), min_hidden=1)) == "abc********efgh"


def test_hash_column(spark):
    assert one(spark, E.hash_column(F.lit("a"))) == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    assert one(spark, E.hash_column(F.lit("a"), "md5")) == "0cc175b9c0f1b6a831c399e269772661"
    with pytest.raises(ValueError):
        E.hash_column("a", "crc")


def test_mask_columns_drops_raw_values(spark):
    df = spark.createDataFrame([(1, "someone@bank.example")], "id int, email string")
    assert projection.mask_columns(df, ["email"]).columns == ["id", "email_masked", "email_hash"]
    assert "email" in projection.mask_columns(df, ["email"], keep_raw=True).columns


def test_safe_add_and_subtract(spark):
    df = spark.createDataFrame([(10, 20, 30), (-7, None, 2), (None, 40, None), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(E.safe_add(["a", "b", "c"])).collect()] == [60, -5, 40, 0]
    assert [r[0] for r in df.select(E.safe_subtract(["a", "b", "c"])).collect()] == [-40, -9, -40, 0]
    with pytest.raises(ValueError):
        E.safe_add([])


def test_safe_divide(spark):
    for n, d, want in [(9, 3, 3.0), (1, 8, 0.125), (0, 7, 0.0), (-12, 5, -2.4), (7, 0, None), (0, 0, None), (7, None, None), (None, 7, None), (None, None, None)]:
        row = spark.createDataFrame([(n, d)], "n int, d int")
        assert row.select(E.safe_divide("n", "d")).first()[0] == want
        assert row.select(E.safe_divide("n", F.col("d") * F.lit(1))).first()[0] == want


def test_width_bucket(spark):
    low, high, buckets = -50.0, 70.0, 6
    for value, bucket in [(-50.01, 0), (-50.0, 1), (-30.5, 1), (-30.0, 2), (0.0, 3), (29.99, 4), (30.0, 5), (69.999, 6), (70.0, 7), (1e9, 7)]:
        assert one(spark, E.width_bucket(F.lit(value), low, high, buckets)) == bucket


def test_haversine(spark):
    # a quarter of a meridian, half of the equator, and no distance at all
    quarter, half = [F.lit(v) for v in (0.0, 12.0, 90.0, -77.0)], [F.lit(v) for v in (0.0, 0.0, 0.0, 180.0)]
    assert one(spark, E.haversine_distance(*quarter)) == pytest.approx(3.141592653589793 / 2 * 3961)
    assert one(spark, E.haversine_distance(*half)) == pytest.approx(3.141592653589793 * 3961)
    assert one(spark, E.haversine_distance(*half, unit="km")) == pytest.approx(3.141592653589793 * 3961 * 1.60934)
    assert one(spark, E.haversine_distance(*[F.lit(v) for v in (60.39, 5.32, 60.39, 5.32)])) == 0
    with pytest.raises(ValueError):
        E.haversine_distance(*half, unit="m")


@pytest.mark.parametrize(
    "url, host",
    [
        ("https://shop.fjordbank.example/loans/42", "shop.fjordbank.example"),
        ("http://fjordbank.example?ref=mail", "fjordbank.example"),
        ("fjordbank.example/about", "fjordbank.example"),
        ("android-app://app.fjordbank.example/", "app.fjordbank.example"),
    ],
)
def test_url_host(spark, url, host):
    assert one(spark, E.url_host(F.lit(url))) == host


@pytest.mark.parametrize(
    "url, path",
    [
        ("https://shop.fjordbank.example/loans/42?ref=mail&x=1", "loans/42"),
        ("http://fjordbank.example/cards/", "cards/"),
        ("fjordbank.example?ref=mail", ""),
        ("localhost", "localhost"),
        (None, None),
    ],
)
def test_url_path(spark, url, path):
    assert one(spark, E.url_path(F.lit(url).cast("string"))) == path


def test_url_parameter(spark):
    df = spark.createDataFrame([("http://fjordbank.example/x?ref=mail",), ("http://fjordbank.example/x?ref=app&lang=nb",)], "url string")
    found = df.select(E.url_parameter("url", "ref"), E.url_parameter("url", "lang")).collect()
    assert [tuple(r) for r in found] == [("mail", None), ("app", "nb")]


def test_slugify():
    assert E.slugify("Fixed Rate (5y)") == "fixed_rate_5y"
    assert E.slugify("30-day notice") == "_30_day_notice"
    assert E.slugify("owner's share") == "owners_share"


def test_safe_casts(spark):
    df = spark.createDataFrame([("12.345",), ("x",), (None,), ("99999999999999.99",)], "v string")
    assert [str(r[0]) for r in df.select(casts.safe_decimal("v")).collect()] == ["12.35", "None", "None", "None"]
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("soon",)], "v string")
    assert [str(r[0]) for r in df.select(casts.safe_timestamp("v")).collect()] == ["None", "2024-02-29 00:00:00", "None"]


@pytest.mark.parametrize(
    "start, end, unit, units",
    [
        ("2024-01-01 00:59:00", "2024-01-01 01:01:00", "hour", 0),
        ("2024-01-31", "2024-02-29", "month", 0),
        ("2024-01-15", "2024-03-14", "month", 1),
        ("2024-03-14", "2024-01-15", "month", -1),
        ("2020-02-29", "2024-02-28", "year", 3),
        ("2024-01-01 23:59:00", "2024-01-02 00:01:00", "day", 0),
    ],
)
def test_date_diff_counts_whole_units(spark, start, end, unit, units):
    moments = [F.lit(v).cast("timestamp") for v in (start, end)]
    assert one(spark, casts.date_diff(*moments, unit)) == units


def test_age_and_years(spark):
    born = F.lit("2000-03-01").cast("timestamp")
    assert one(spark, casts.age_years(born, "2004-02-29")) == 3
    assert one(spark, casts.age_years(born, "2004-03-01")) == 4
    assert str(one(spark, casts.add_years(F.lit("2020-02-29").cast("timestamp"), 5))) == "2025-02-28 00:00:00"


def test_banded_first_floor_wins(spark):
    df = spark.createDataFrame([(10,), (9,), (None,)], "v int")
    assert [r[0] for r in df.select(E.banded("v", [(10, "a"), (5, "b")], "c")).collect()] == ["a", "b", "c"]
    assert [r[0] for r in df.select(E.banded("v", [(10, "a"), (5, "b")], "c", strict=True)).collect()] == ["b", "b", "c"]
