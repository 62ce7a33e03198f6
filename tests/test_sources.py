"""Sources, table writes, upserts and the stream form."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F, types as T

from ledgerloom.session import drop_scratch, materialise, scratch_dir, scratch_path, scratch_table
from ledgerloom.sources import marks, registry, rejects, tables
from ledgerloom.streaming.upserts import stream_upsert


@pytest.fixture
def name(spark, request):
    table = f"t_{abs(hash(request.node.name)) % 10**9}_{random.randint(0, 10**6)}"
    yield table
    for t in (table, f"{table}_2", f"{table}__next", f"{table}__previous"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_scratch_follows_the_session_setting(spark, tmp_path):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = materialise(spark.range(5), "kept")
    assert stored.count() == 5
    name = scratch_table(spark, "kept")
    tables.upsert(spark.range(5), name, "id", buckets=2)
    assert spark.table(name).count() == 5
    assert drop_scratch(spark) > 0 and drop_scratch(spark) == 0
    assert not spark.catalog.tableExists(name)


def test_csv_source_and_load(spark, tmp_path, rows):
    folder = tmp_path / "branches"
    folder.mkdir()
    (folder / "a.csv").write_text("branch_id,branch_name,manager_name,city,country\n1,Main,Ann,,NO\n")
    (folder / "b.csv").write_text('branch_id,branch_name,manager_name,city,country\n2,"Side, East",,Oslo,""\n')
    df = registry.read_source(spark, "branches", str(tmp_path))
    assert rows(df) == [("1", "Main", "Ann", None, "NO"), ("2", "Side, East", None, "Oslo", None)]
    loaded = registry.load_source(spark, "branches", str(tmp_path))
    assert rows(loaded) == rows(df)
    assert rows(registry.load_source(spark, "branches", str(tmp_path))) == rows(df)  # replaced, not appended
    spark.sql("DROP TABLE branches")


def test_create_table_from_csv_options_win(spark, tmp_path, name, rows):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "x.csv").write_text("a;b\n1;x\n2;-\n")
    df = registry.create_table_from_csv(spark, name, str(tmp_path / "f"), options={"delimiter": ";", "nullValue": "-"})
    assert df.schema.simpleString() == "struct<a:int,b:string>"
    assert rows(df) == [(1, "x"), (2, None)]


def test_load_all_sources(spark, tmp_path):
    for source, schema in registry.SCHEMAS.items():
        (tmp_path / source).mkdir()
        (tmp_path / source / "p.csv").write_text(",".join(schema.names) + "\n" + ",".join("1" for _ in schema.names) + "\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    loaded = registry.load_all(spark, str(tmp_path), "raw")
    assert sorted(loaded) == sorted(registry.SCHEMAS) and all(df.count() == 1 for df in loaded.values())
    spark.sql("DROP DATABASE raw CASCADE")


def test_partitioned_create_if_absent_and_overwrite(spark, name, rows):
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-01-05"), (3, "2024-02-07"), (4, "bad")], "id int, d string")
    made = registry.create_partitioned_if_absent(df, name, "d")
    assert made.columns == ["id", "d", "year", "month", "day"]
    again = registry.create_partitioned_if_absent(df.limit(1), name, "d")
    assert again.count() == 4
    registry.insert_overwrite(registry.with_date_parts(spark.createDataFrame([(9, "2024-01-05")], "id int, d string"), "d"), name)
    assert rows(spark.table(name), "id") == [(3,), (4,), (9,)]
    registry.insert_overwrite(registry.with_date_parts(spark.createDataFrame([(8, "2024-01-05")], "id int, d string"), "d"), name, dynamic=False)
    assert rows(spark.table(name), "id") == [(8,)]


def test_rebuild_reading_itself_and_view(spark, name, rows):
    tables.write_table(spark.range(3), name)
    out = tables.write_table(spark.table(name).withColumn("id", F.col("id") + 1), name)
    assert rows(out) == [(1,), (2,), (3,)]
    assert rows(tables.create_view(out.filter("id > 1"), "some_view")) == [(2,), (3,)]


def test_write_partitioned_sorts_inside_files(spark, name):
    df = spark.range(200).select((F.col("id") % 2).alias("p"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"))
    tables.write_partitioned(df, name, ["p"], ["v"])
    files = spark.table(name).withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    by_file = {}
    for r in files.orderBy("i").collect():
        by_file.setdefault(r.f, []).append(r.v)
    assert all(v == sorted(v) for v in by_file.values()) and len(by_file) == 2


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_upsert_equals_dictionary(spark, name, rows, parts):
    random.seed(3)
    model, table = {}, None
    for _ in range(4):
        batch = {random.choice([None, *range(30)]): (random.choice(["a", "b", None, "it's"]), random.randint(0, 99)) for _ in range(12)}
        model.update(batch)
        df = spark.createDataFrame([(k, p, v) for k, (p, v) in batch.items()], "k int, p string, v int")
        table = tables.upsert(df, name, "k", parts, buckets=3)
        assert rows(table, "k", "p", "v") == sorted([(k, p, v) for k, (p, v) in model.items()], key=repr)
        assert rows(tables.upsert(df, name, "k", parts), "k", "p", "v") == rows(table, "k", "p", "v")  # a repeat changes nothing
    assert rows(tables.upsert(df.limit(0), name, "k", parts, buckets=3), "k", "p", "v") == rows(table, "k", "p", "v")


def test_upsert_refuses_duplicate_keys(spark, name):
    for key in (1, None):
        df = spark.createDataFrame([(key, 2), (key, 3)], "k int, v int")
        with pytest.raises(ValueError):
            tables.upsert(df, name, "k")
        assert not spark.catalog.tableExists(name)


def test_upsert_refuses_another_bucket_count(spark, name, rows):
    df = spark.range(100).select("id", F.lit("a").alias("v"))
    tables.upsert(df, name, "id", buckets=8)
    with pytest.raises(ValueError):
        tables.upsert(df, name, "id", buckets=64)
    assert tables.upsert(df.withColumn("v", F.lit("b")), name, "id").groupBy("v").count().collect() == [("b", 100)]


def test_upsert_moves_rows_and_empties_partitions(spark, name, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k int, p string")
    tables.upsert(df, name, "k", ["p"])
    moved = spark.createDataFrame([(3, "a"), (4, "c"), (1, "c")], "k int, p string")
    assert rows(tables.upsert(moved, name, "k", ["p"])) == [(1, "c"), (2, "a"), (3, "a"), (4, "c")]
    places = spark.createDataFrame([("c",), ("a",)], "p string")
    back = tables.upsert(df.filter("k <> 2"), name, "k", ["p"], moved=places)
    assert rows(back) == sorted([(1, "a"), (2, "a"), (3, "b"), (4, None)], key=repr)
    stay = tables.upsert(spark.createDataFrame([(2, "a"), (9, "b")], "k int, p string"), name, "k", ["p"], keys_stay=True)
    assert rows(stay) == sorted([(1, "a"), (2, "a"), (3, "b"), (4, None), (9, "b")], key=repr)


def test_upsert_adds_columns_without_a_rewrite(spark, name, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    tables.upsert(df, name, "k", ["p"])
    files = lambda: {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    wide = tables.upsert(spark.createDataFrame([(2, "b", 5)], "k int, p string, x int"), name, "k", ["p"])
    assert rows(wide, "k", "p", "x") == sorted([(1, "a", None), (2, "b", 5)], key=repr)
    assert [f for f in before & files() if "p=a" in f] and not [f for f in before & files() if "p=b" in f]


def test_upsert_rewrites_touched_partitions_only(spark, name):
    df = spark.range(40).select("id", (F.col("id") % 4).alias("p"))
    tables.upsert(df, name, "id", ["p"])
    files = lambda: {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    tables.upsert(df.filter("id = 2"), name, "id", ["p"])
    kept = before & files()
    assert {f.split("/p=")[1][0] for f in before - kept} == {"2"}


def test_upsert_schema_changes(spark, name, rows):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    new = spark.createDataFrame([(2, "c", 1.5), (3, "d", 2.5)], "k int, x string, z double")
    tables.upsert(old, name, "k", buckets=2)
    appended = tables.upsert(new, name, "k", buckets=2)
    assert rows(appended, "k", "x", "y", "z") == sorted([(1, "a", 1, None), (2, "c", None, 1.5), (3, "d", None, 2.5)], key=repr)
    synced = tables.upsert(new.drop("x"), name, "k", buckets=2, on_schema_change="sync_all_columns")
    assert synced.columns == ["k", "z"] and rows(synced) == sorted([(1, None), (2, 1.5), (3, 2.5)], key=repr)
    with pytest.raises(ValueError):
        tables.upsert(new, name, "k", buckets=2, on_schema_change="fail")
    ignored = tables.upsert(new.withColumn("z", F.lit(9.0)), name, "k", buckets=2, on_schema_change="ignore")
    assert rows(ignored) == sorted([(1, None), (2, 9.0), (3, 9.0)], key=repr)


def test_high_water_mark(spark, rows):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "id int, d int")
    assert tables.newer_than_mark(source, None, "d").count() == 4
    assert tables.newer_than_mark(source, source.limit(0), "d").count() == 4
    # strictly later only
    assert rows(tables.newer_than_mark(source, source.filter("d <= 20"), "d"), "id") == [(4,)]


def test_rows_of_affected_includes_null(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id int, k string")
    assert rows(tables.rows_of_affected(df, df.filter("id in (2, 3)"), "k"), "id") == [(1,), (2,), (3,)]


def test_stream_upsert_picks_up_late_files(spark, tmp_path, name, rows):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, version int, v string")
    go = lambda: stream_upsert(spark, source, first.schema, name, "k", "version", checkpoint, buckets=2)
    (tmp_path / "in").mkdir()
    assert rows(go()) == []
    first.write.mode("append").parquet(source)
    assert rows(go()) == [(1, 2, "b"), (2, 1, "c")]
    # the file is picked up although it is late; its older row does not replace the newer one
    spark.createDataFrame([(2, 0, "late"), (3, 5, "new")], first.schema).write.mode("append").parquet(source)
    assert rows(go()) == [(1, 2, "b"), (2, 1, "c"), (3, 5, "new")]
    assert rows(go()) == [(1, 2, "b"), (2, 1, "c"), (3, 5, "new")]


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_stream_upsert_does_not_depend_on_the_order_of_files(spark, tmp_path, name, rows, parts):
    schema = "k int, version int, v string, p string"
    files = [
        [(1, 1, "a", "x"), (None, 1, "none", "x"), (2, None, "?", "y")],
        [(1, 3, "c", "y"), (2, 1, "b", "x"), (3, 2, "tie", "x")],
        [(1, 2, "b", "x"), (None, 2, "later", None), (3, 2, "eit", "y")],
    ]
    results = set()
    for n, order in enumerate(itertools.permutations(range(3))):
        table, source = f"{name}_o{n}", str(tmp_path / f"in{n}")
        go = lambda run: stream_upsert(spark, source, first.schema, table, "k", "version", f"{source}-{run}", partition_by=parts)  # noqa: B023, E731
        for k in order:
            first = spark.createDataFrame(files[k], schema)
            first.write.mode("append").parquet(source)
            go("checkpoint")
        results.add(tuple(rows(go("replayed"), "k", "version", "v", "p")))
        spark.sql(f"DROP TABLE {table}")
    (only,) = results
    assert {r[:2] for r in only} == {(None, 2), (1, 3), (2, 1), (3, 2)}


SHAPE = T.StructType().add("k", "long").add("price", "double").add("day", "date").add("note", "string")


def write_lines(path, *files):
    path.mkdir()
    for i, lines in enumerate(files):
        (path / f"{i}.csv").write_text("\n".join(["k,price,day,note", *lines]) + "\n")
    return str(path)


def test_rejected_records_are_kept_whole(spark, tmp_path, rows):
    good = ["1,2.5,2024-01-02,a", "2,,2024-01-02,", '3,1.0,2024-01-03,"x, y"', ""]
    bad = ["x,2.5,2024-01-02,a", "4,2.5", "5,2.5,2024-01-02,a,b", "6,much,2024-01-02,a", "7,1.0,someday,a"]
    path = write_lines(tmp_path / "in", good + bad[:2], bad[2:])
    accepted, rejected = rejects.read_csv_checked(spark, path, SHAPE)
    assert accepted.schema.names == SHAPE.names
    assert rows(accepted, "k", "price", "note") == [(1, 2.5, "a"), (2, None, None), (3, 1.0, "x, y")]
    assert sorted(r[0] for r in rejected.select(rejects.RECORD).collect()) == sorted(bad)
    assert {r[0].rsplit("/", 1)[1] for r in rejected.select(rejects.FILE).collect()} == {"0.csv", "1.csv"}
    # a projection of the accepted rows judges records by all columns
    assert accepted.select("k").count() == 3


def test_rejects_of_good_files_are_empty_and_options_are_checked(spark, tmp_path, name):
    path = write_lines(tmp_path / "in", ["1,2.5,2024-01-02,a"])
    taken, lost = rejects.create_table_and_rejects(spark, name, path, SHAPE)
    assert taken.count() == 1 and lost.count() == 0 and spark.table(f"{name}__rejects").columns == [rejects.RECORD, rejects.FILE]
    spark.sql(f"DROP TABLE {name}__rejects")
    with pytest.raises(ValueError, match="permissive"):
        rejects.read_csv_checked(spark, path, SHAPE, {"mode": "DROPMALFORMED"})
    with pytest.raises(ValueError, match="columns of rejected"):
        rejects.read_csv_checked(spark, path, T.StructType([*SHAPE.fields, T.StructField(rejects.RECORD, T.StringType())]))


def test_files_are_read_once_each_late_and_equal_times_too(spark, tmp_path, name, rows):
    root, seen = str(tmp_path / "drops"), []
    schema = T.StructType().add("k", "long").add("day", "date")
    marked = f"{name}_2"

    def arrive(*drop):
        spark.createDataFrame([(k, dt.date(2024, 1, d)) for k, d in drop], schema).coalesce(1).write.mode("append").parquet(root)

    def take():
        taken, files = marks.read_unread(spark, root, marked, schema)
        seen.extend(k for k, _ in rows(taken))
        marks.mark_read(files, marked)
        return files.count()

    arrive((1, 10), (2, 11))
    assert take() == 1 and take() == 0
    arrive((3, 11))  # as new as the mark
    arrive((4, 2))  # older than the mark
    assert take() == 2 and sorted(seen) == [1, 2, 3, 4]


def test_files_that_are_not_marked_come_again(spark, tmp_path, name):
    root = str(tmp_path / "drops")
    spark.range(3).coalesce(1).write.parquet(root)
    for _ in range(2):
        taken, files = marks.read_unread(spark, root, name, spark.range(0).schema)
        assert taken.count() == 3 and files.count() == 1
