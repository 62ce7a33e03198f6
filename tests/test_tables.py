"""Table operators against small tables of their own and properties."""

import datetime as dt
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import generators, keys, projection, proximity, reshape, unions, values, web
from ledgerloom.session import scratch_dir
from ledgerloom.sources import catalog


@pytest.fixture(scope="module")
def desks(spark):
    return spark.createDataFrame([(1, "Bergen", 4.5), (2, "Oslo", 6.0)], "desk_id int, town string, hours double")


def test_star(desks):
    assert projection.star(desks, ["HOURS"]).columns == ["desk_id", "town"]
    assert projection.star(desks, prefix="d_", suffix="_x").columns == ["d_desk_id_x", "d_town_x", "d_hours_x"]
    assert projection.star(desks, ["desk_id", "town", "hours"]).columns == []


def test_filtered_and_staging_columns(desks):
    assert projection.filtered_columns(desks, ["Town"]) == ["desk_id", "hours"]
    assert projection.staging_columns(desks, ["Desk_id", "town"]).columns == ["desk_id", "hours"]


def test_group_by_the_kept_columns(spark, rows):
    df = spark.createDataFrame([("north", 1, 10), ("north", 1, 5), ("south", 1, 7), ("south", 2, 1)], "area string, floor int, visits int")
    grouped = projection.star(df, ["visits"]).columns
    assert rows(df.groupBy(*grouped).agg(F.sum("visits"))) == [("north", 1, 15), ("south", 1, 7), ("south", 2, 1)]
    assert rows(projection.group_by_first(df, 2).agg(F.count(F.lit(1)))) == [("north", 1, 2), ("south", 1, 1), ("south", 2, 1)]


def test_nullcheck(spark, rows):
    df = spark.createDataFrame([(1, "", "x"), (2, "y", ""), (3, " ", None)], "id int, p string, q string")
    assert rows(projection.nullcheck(df)) == sorted([(1, None, "x"), (2, "y", None), (3, " ", None)], key=repr)
    assert rows(projection.nullcheck(df, ["p"])) == sorted([(1, None, "x"), (2, "y", ""), (3, " ", None)], key=repr)


def test_pivot(spark, rows):
    df = spark.createDataFrame([("d1", "card fee"), ("d1", "loan fee"), ("d1", "owner's fee"), ("d2", "card fee"), ("d2", "card fee")], "desk string, kind string")
    plain = reshape.pivot(df, ["desk"], "kind", ["card fee", "loan fee"])
    assert plain.columns == ["desk", "card fee", "loan fee"] and rows(plain) == [("d1", 1, 1), ("d2", 2, 0)]
    slugged = reshape.pivot(df, ["desk"], "kind", ["card fee", "owner's fee"], slug=True, prefix="n ")
    assert slugged.columns == ["desk", "n_card_fee", "n_owners_fee"] and rows(slugged) == [("d1", 1, 1), ("d2", 2, 0)]


def test_pivot_options(spark, rows):
    df = spark.createDataFrame([("S", 1, 5), ("S", 2, 7), ("S", 2, 7)], "size string, n int, v int")
    assert rows(reshape.pivot(df, ["size"], "n", [1], cmp=">", then_value="v")) == [("S", 14)]
    assert rows(reshape.pivot(df, ["size"], "n", [2], then_value="v", distinct=True)) == [("S", 7)]
    assert rows(reshape.pivot(df, ["size"], "n", [2], agg="max", then_value="v", else_value=None)) == [("S", 7)]
    with pytest.raises(ValueError):
        reshape.pivot(df, ["size"], "n", [2], agg="mode")


@pytest.fixture(scope="module")
def plans(spark):
    data = [(7, dt.date(2021, 5, 3), "open", 3, "Ida"), (8, dt.date(2022, 6, 4), "closed", 12, "Jon"), (9, dt.date(2023, 7, 5), "open", None, "Kim")]
    return spark.createDataFrame(data, "plan_id int, begun date, state string, months int, adviser string")


def test_unpivot(plans, rows):
    out = reshape.unpivot(plans, exclude=["plan_id", "begun"], remove=["adviser"], field_name="what", value_name="is")
    assert out.columns == ["plan_id", "begun", "what", "is"]
    want = [(7, "months", "3"), (7, "state", "open"), (8, "months", "12"), (8, "state", "closed"), (9, "months", None), (9, "state", "open")]
    assert rows(out, "plan_id", "what", "is") == sorted(want, key=repr)
    every = reshape.unpivot(plans, exclude=["plan_id", "begun"])
    assert every.columns[2:] == ["field_name", "value"] and every.count() == 9


def test_unpivot_booleans_and_nulls(spark, rows):
    df = spark.createDataFrame([(5, False), (6, None), (7, True)], "id int, settled boolean")
    assert rows(reshape.unpivot(df, exclude=["id"]), "id", "value") == [(5, "false"), (6, None), (7, "true")]


def test_unpivot_then_pivot_restores_the_table(plans, rows):
    long = reshape.unpivot(plans, exclude=["plan_id"], field_name="f", value_name="v")
    names = ["begun", "state", "months", "adviser"]
    wide = reshape.pivot(long, ["plan_id"], "f", names, agg="max", then_value="v", else_value=None)
    assert rows(wide) == rows(plans.select("plan_id", *[F.col(n).cast("string") for n in names]))


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([("k", 3, "old"), ("k", 9, "new"), ("l", 1, "only")], "key string, at int, v string")
    assert rows(reshape.deduplicate(df, ["key"], [("at", "desc")])) == [("k", 9, "new"), ("l", 1, "only")]


def test_deduplicate_keeps_nulls_and_mixed_order(spark, rows):
    data = [(1, None, 5), (1, "x", 5), (1, "a", 9), (None, "n", 1), (None, "m", None)]
    df = spark.createDataFrame(data, "k int, name string, v int")
    assert rows(reshape.deduplicate(df, ["k"], [("v", "asc"), ("name", "asc")])) == [(1, None, 5), (None, "m", None)]
    assert rows(reshape.deduplicate(df, ["k"], [("v", "desc"), ("name", "asc")])) == [(1, "a", 9), (None, "n", 1)]
    assert rows(reshape.deduplicate(df, ["k"], [("name", "desc"), ("v", "asc")])) == [(1, "x", 5), (None, "n", 1)]
    with pytest.raises(ValueError):
        reshape.deduplicate(df, ["k"], [("name", "down")])


def test_deduplicate_orders_text_downwards_like_a_sort(spark):
    texts = ["", "a", "ab", "b", "é", "z", "Z", "日本", "𝒳", "a\u0000", None]
    df = spark.createDataFrame([(k, t, i) for i, t in enumerate(texts) for k in range(i, len(texts))], "k int, t string, i int")
    got = {r.k: r.i for r in reshape.deduplicate(df, ["k"], [("t", "desc"), ("i", "asc")]).collect()}
    rank = lambda t: (t is not None, (t or "").encode())
    assert got == {k: max(range(k + 1), key=lambda i: (rank(texts[i]), -i)) for k in range(len(texts))}


def test_generate_series(spark):
    assert [r[0] for r in generators.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        generators.generate_series(spark, 0)


def test_date_spine(spark, rows):
    spine = generators.date_spine(spark, "day", "2023-11-28", "2023-12-03")
    assert [str(r[0]) for r in spine.orderBy("date_day").collect()] == ["2023-11-28", "2023-11-29", "2023-11-30", "2023-12-01", "2023-12-02"]
    assert generators.date_spine(spark, "month", "2023-10-31", "2024-03-01").count() == 5
    assert generators.date_spine(spark, "hour", "2023-11-28", "2023-11-29 01:30:00").count() == 26
    assert generators.date_spine(spark, "day", "2023-11-28", "2023-11-01").count() == 0
    with pytest.raises(ValueError):
        generators.date_spine(spark, "century", "2018-01-01", "2018-01-10")


@pytest.mark.parametrize("part, start, end, periods", [("minute", "2024-01-01", "2024-01-08", 10_080), ("week", "2024-01-03", "2024-02-01", 5), ("quarter", "2023-01-01", "2024-01-02", 5), ("year", "2020-02-29", "2024-02-28", 4), ("day", "2024-01-02", "2024-01-02", 0)])
def test_fill_periods_makes_the_spine_for_every_key(spark, monkeypatch, part, start, end, periods):
    monkeypatch.setattr(generators, "PERIODS_PER_BLOCK", 7)
    facts = spark.createDataFrame([("a", start, 2), ("b", "1999-01-01", 5)], "k string, t string, v int").withColumn("t", F.col("t").cast("timestamp"))
    out = generators.fill_periods(facts, part, "t", start, end, {"total": F.sum("v")}, ["k"], "p")
    assert out.count() == out.select("k", "p").distinct().count() == 2 * periods
    spine = generators.date_spine(spark, part, start, end, "p")
    assert out.select("p").distinct().exceptAll(spine).count() == 0 and out.agg(F.sum("total")).first()[0] == (2 if periods else None)


def test_fill_periods_has_every_period_and_key(spark, rows):
    facts = spark.createDataFrame([("a", "2024-01-01 05:00:00", 3), ("a", "2024-01-03 00:00:00", 4), (None, "2024-01-02 23:59:59", 5), ("b", "2023-12-31 10:00:00", 9)], "k string, t string, v int")
    facts = facts.withColumn("t", F.col("t").cast("timestamp"))
    out = generators.fill_periods(facts, "day", "t", "2024-01-01", "2024-01-04", {"total": F.sum("v")}, ["k"], "d")
    assert out.count() == 9
    assert rows(out.filter("total > 0"), "k", "total") == [("a", 3), ("a", 4), (None, 5)]


def test_union_relations(spark, rows):
    leases = spark.createDataFrame([(11, "Vik", "12.5"), (12, "Moe", None)], "ref int, holder string, rate string")
    safes = spark.createDataFrame([(21, 3, "A-7"), (22, 4, "B-1")], "ref int, rate int, box string")
    tables = {"leases": leases, "safes": safes}
    out = unions.union_relations(tables, source_column_name=None)
    assert out.columns == ["ref", "holder", "rate", "box"] and [k for _, k in out.dtypes] == ["int", "string", "string", "string"]
    want = [(11, "Vik", "12.5", None), (12, "Moe", None, None), (21, None, "3", "A-7"), (22, None, "4", "B-1")]
    assert rows(out) == sorted(want, key=repr)
    for exclude in (["holder"], ["HOLDER"]):
        assert unions.union_relations(tables, exclude=exclude, source_column_name=None).columns == ["ref", "rate", "box"]
    assert unions.union_relations(tables, include=["REF"]).columns == ["_dbt_source_relation", "ref"]
    assert rows(unions.union_relations(tables, where="ref % 10 = 1"), "ref", "box") == sorted([(11, None), (21, "A-7")], key=repr)
    assert dict(unions.union_relations(tables, column_override={"REF": "string"}).dtypes)["ref"] == "string"
    for wrong in ({"include": ["ref"], "exclude": ["box"]}, {"include": ["absent"]}):
        with pytest.raises(ValueError):
            unions.union_relations(tables, **wrong)


def test_union_relations_matches_names_without_case(spark, rows):
    tables = {"a": spark.createDataFrame([(1, "x")], "id int, note string"), "b": spark.createDataFrame([("y", 2)], "NOTE string, ID int")}
    out = unions.union_relations(tables, source_column_name=None)
    assert out.columns == ["id", "note"] and rows(out) == [(1, "x"), (2, "y")]


def test_relations_by_prefix_and_pattern(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS vault")
    for n, desk in enumerate(("oslo", "bergen", "voss")):
        spark.createDataFrame([(n, desk), (n + 10, desk)], "ticket int, desk string").write.mode("overwrite").saveAsTable(f"vault.Queue_{desk}_q{n}")
    spark.range(1).createOrReplaceTempView("queue_shown")
    found = catalog.relations_by_prefix(spark, "vault", "QUEUE_")
    assert [tuple(r) for r in found.collect()][0] == ("vault", "queue_bergen_q1", "table") and found.count() == 3
    union = unions.union_relations(catalog.open_relations(found), source_column_name=None)
    assert rows(union) == sorted([(0, "oslo"), (10, "oslo"), (1, "bergen"), (11, "bergen"), (2, "voss"), (12, "voss")], key=repr)
    assert catalog.relations_by_pattern(spark, "vau%", "%queue%", exclude="%_q0").count() == 2
    assert catalog.relations_by_pattern(spark, "vault", "queue__slo_q_").count() == 1


def test_value_frequencies_and_lists(spark):
    df = spark.createDataFrame([(v,) for v in "xyzzyxzz"], "mark string")
    assert [tuple(r) for r in values.value_frequencies(df, "mark").collect()] == [("z", 4), ("x", 2), ("y", 2)]
    assert values.column_values(spark, df, "mark") == ["z", "x", "y"]
    assert values.column_values(spark, df, "mark", where="mark < 'z'") == ["x", "y"]
    assert values.column_values(spark, df, "mark", max_records=2) == ["z", "x"]
    assert values.column_values(spark, df, "mark", order_by=[F.desc("value")]) == ["z", "y", "x"]
    assert values.column_values(spark, "no_such_table", "mark", default=["q"]) == ["q"]
    assert values.column_values(spark, df.limit(0), "mark", default=["q"]) == ["q"]
    for wrong in (lambda: values.column_values(spark, "no_such_table", "mark"), lambda: values.column_values(spark, df, "mark", refuse_above=2)):
        with pytest.raises(ValueError):
            wrong()


def test_single_value(spark):
    df = spark.createDataFrame([(31, 2.5), (32, 7.5)], "n int, share double")
    assert values.single_value(df.agg(F.max("n"))).first()["value"] == 32
    assert values.single_value(df.agg(F.min("share"))).first()["value"] == 2.5
    nothing = df.filter("n > 99").select("n")
    assert values.single_value(nothing, -5).first()["value"] == -5 and values.single_value(nothing).first()["value"] is None
    # a NULL that is there is not replaced
    assert values.single_value(spark.sql("select cast(null as int) as v"), 7).first()["value"] is None


def test_histogram_and_net_totals(spark, rows):
    df = spark.createDataFrame([("a", 5, None), ("a", 15, 2), ("b", None, 3), ("b", 25, None)], "g string, x int, y int")
    assert rows(values.histogram(df.filter("x is not null"), "x", 10, 20, 2)) == [(0, 1, 5), (2, 1, 15), (3, 1, 25)]
    assert rows(values.net_totals(df, ["g"], ["x", "y"])) == [("a", 22, 18, 10.0), ("b", 28, 22, 25 / 3)]


def test_key_report(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    report = keys.key_report(df, ["k", "v"])
    assert rows(report, "n_rows", "n_inputs", "is_collision") == [(2, 1, False), (2, 1, False)]


def test_top_paths(spark, rows):
    urls = ["http://a.com/x"] * 3 + ["http://a.com/y"] * 2 + ["https://a.com/z"] * 2 + ["b.com/q?x=1"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert rows(web.top_paths(df, 2, salts=3)) == [("a.com", "x", 3, 1), ("a.com", "y", 2, 2), ("b.com", "q", 1, 1)]


def miles(a, b):
    (la, lo), (lb, lp) = a, b
    h = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.sin(math.radians(lp - lo) / 2) ** 2
    return 2 * 3961 * math.asin(math.sqrt(min(1, h)))


@pytest.mark.parametrize("radius, hot_rows", [(0.0, 20000), (0.0, 2), (5.0, 20000), (120.0, 20000), (900.0, 20000), (900.0, 3), (20000.0, 20000)])
def test_proximity_pairs_equals_brute_force(spark, radius, hot_rows):
    # poles, the date line, one point many times
    left = [(i, ((i * 7919) % 17999) / 100 - 90, ((i * 104729) % 36001) / 100 - 180) for i in range(150)]
    left += [(200 + i, 89.99, i * 36.0 - 180) for i in range(10)] + [(300 + i, 10.0, 179.99) for i in range(12)]
    right = [(i, ((i * 6101) % 17999) / 100 - 90, ((i * 7001) % 36001) / 100 - 180) for i in range(60)]
    right += [(100, 10.0, -179.99), (101, 90.0, 0.0), (102, -90.0, 17.0), (103, 10.02, 180.0), (104, 10.0, 179.99)] + [(110 + i, 10.0, -179.9) for i in range(9)]
    a = spark.createDataFrame(left, "left_id int, lat double, lon double")
    b = spark.createDataFrame(right, "right_id int, lat double, lon double")
    got = sorted((r.left_id, r.right_id) for r in proximity.proximity_pairs(a, b, radius, "mi", hot_rows=hot_rows).collect())
    want = sorted((x[0], y[0]) for x in left for y in right if miles(x[1:], y[1:]) <= radius)
    assert got == want


def test_deduplicate_mixed_directions_at_the_ends_of_types(spark):
    least, nan = -(2**63), float("nan")
    rows = [(1, 5.0, 1, 3), (1, nan, 2, least), (1, None, 3, 7), (2, -0.5, 1, least), (2, float("-inf"), 2, None), (3, None, 1, least), (3, None, 2, 2**63 - 1)]
    df = spark.createDataFrame(rows, "k int, v double, id int, n long")
    pick = lambda order: {r["k"]: r["id"] for r in reshape.deduplicate(df, ["k"], order).collect()}
    for order in ([("v", "desc"), ("id", "asc")], [("n", "desc"), ("id", "asc")], [("id", "asc"), ("n", "desc")], [("n", "asc"), ("v", "desc")]):
        want = {}
        for r in reversed(df.orderBy(*[F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in order]).collect()):
            want[r["k"]] = r["id"]
        assert pick(order) == want, order


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_fill_periods_with_an_end_before_the_start_is_empty(spark, keys):
    facts = spark.createDataFrame([(1, "2024-01-05 00:00:00")], "k int, t string")
    got = generators.fill_periods(facts, "day", "t", "2024-01-08", "2024-01-05", {"n": F.count(F.lit(1))}, keys)
    assert got.collect() == [] and got.columns == [*keys, "period", "n"]


def test_periods_beyond_the_int_range(spark):
    spine = generators.date_spine(spark, "second", "1900-01-01", "2024-01-01").filter("date_second >= timestamp'2023-12-31 23:59:58'")
    assert [str(r[0]) for r in spine.orderBy("date_second").collect()] == ["2023-12-31 23:59:58", "2023-12-31 23:59:59"]


@pytest.mark.parametrize("hot_rows", [20000, 1])
def test_proximity_pairs_of_one_place_are_spread_by_their_number(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(proximity, "PAIRS_PER_TASK", 1000, raising=False)
    monkeypatch.setattr(proximity, "PAIRS_PER_SLICE", 500, raising=False)
    side = lambda name, n: spark.range(n).select(F.col("id").alias(name), (F.col("id") % 1 + 10.0).alias("lat"), (F.col("id") % 1 + 20.0).alias("lon"))
    found = proximity.proximity_pairs(side("left_id", 200), side("right_id", 100), 0.0, hot_rows=hot_rows)
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == found.distinct().count() == 20_000
    assert len(tasks) > 5 and max(r["count"] for r in tasks) < 8000


def test_cells_are_not_cut_into_more_slices_than_copies_allow(spark):
    n = spark.createDataFrame([(1,), (64,), (1000,), (10_000_000,)], "n long")
    cut = lambda hot_rows: [r[0] for r in n.select(proximity._slices(F.col("n"), hot_rows)).collect()]
    assert cut(1) == [1, 64, 64, 500] and cut(100) == [1, 1, 10, 500] and cut(10**9) == [1, 1, 1, 1]


def test_copies_of_points_follow_the_pairs_of_a_cell(spark, monkeypatch):
    monkeypatch.setattr(proximity, "PAIRS_PER_SLICE", 500)
    side = lambda n: spark.range(n).select(F.lit(1).alias("_band"), F.lit(1).alias("_cell"))
    met = proximity._met_cells(side(2000), side(500), 20_000).first()
    assert met["_pairs"] == 1_000_000 <= 500 * met["_na"] * met["_nb"]
    assert 2000 * met["_nb"] + 500 * met["_na"] < 3 * 1_000_000 / 500**0.5
    monkeypatch.undo()
    few = proximity._met_cells(side(2000), side(500), 1).first()  # not 64 copies of each point for a million pairs
    assert (few["_na"], few["_nb"]) == (8, 8)
    assert proximity._met_cells(side(50_000), side(3), 1).first()["_na"] == 8


def test_late_rows_of_a_file_are_counted_in_bounded_pieces(spark, rows, monkeypatch):
    import registry

    monkeypatch.setattr(registry, "ROWS_IN_PIECE", 4)
    # places 0 to 9 of file 1, 10 to 12 of file 2; later ones smaller inside a piece and where two meet
    values = [5, 4, 6, 7, 6, 8, 9, 9, 1, None, 3, 2, 2]
    placed = spark.createDataFrame([("x", v, 1 if at < 10 else 2, at) for at, v in enumerate(values)] + [("y", 1, 2, 13)], "k string, v int, _file long, _at long")
    found = registry._late_rows(placed, ["v"], "k")
    assert rows(found) == [("x", 13, 5), ("y", 1, 0)]


def test_forms_are_compared_without_writing_them(spark, rows):
    import registry

    folder, nan = Path(scratch_dir(spark)), float("nan")
    before = set(folder.glob("form-*"))
    df = spark.createDataFrame([(1, "a", nan), (1, "a", nan), (2, None, None)], "k int, v string, x double")
    other = df.dropDuplicates().unionByName(spark.createDataFrame([(3, "c", 0.0)], df.schema))
    found = registry._agreement({"first": df, "same": df.orderBy(F.desc("k")), "other": other, "none": df.limit(0)})
    assert rows(found, "form", "n_rows", "n_differing") == [("first", 3, 0), ("none", 0, 3), ("other", 3, 2), ("same", 3, 0)]
    assert set(folder.glob("form-*")) == before


def test_forms_that_agree_are_not_exchanged(spark, rows):
    import registry

    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    found = registry._agreement({"first": df, "same": df.orderBy(F.desc("id")), "again": df})
    assert "Range" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == [("again", 1000, 0), ("first", 1000, 0), ("same", 1000, 0)]
    nested = df.select("k", F.array("id").alias("ids"))  # has no checksum
    found = registry._agreement({"first": nested, "fewer": nested.filter("k > 0"), "none": nested.limit(0)})
    assert rows(found) == [("fewer", 857, 143), ("first", 1000, 0), ("none", 0, 1000)]
