"""Write tables: full rebuilds, schema changes and upserts by key.

A table without partitions is rebuilt under another name and then takes the old one's place, so the plan may
read the table it replaces, everything is written once, and a failure leaves the old table. (Catalogs may
keep the place of every partition through a rename, so partitioned tables are not swapped like this.)
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ordered import same_keys
from ..session import materialise
from .registry import insert_overwrite

BUCKET = "_key_bucket"
PIECE_ROWS = 500_000  # of a partition that one task writes
BUCKETS = 64  # of a new table without partition columns
BUCKETS_PROPERTY = "ledgerloom.key_buckets"


def _replace(spark: SparkSession, table: str, write: Callable[[str], None]) -> DataFrame:
    """Writes a table aside and swaps it in."""
    following, previous = f"{table}__next", f"{table}__previous"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    write(following)
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def write_table(df: DataFrame, table: str, table_format: str = "parquet") -> DataFrame:
    """Full rebuild; the plan may read the table it replaces."""
    return _replace(df.sparkSession, table, lambda name: df.write.format(table_format).saveAsTable(name))


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A named, unmaterialised plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_partitioned(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    table_format: str = "parquet",
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Partitioned rebuild with rows sorted by ``cluster_by`` inside each file.

    Rebalancing sends each partition value to as many tasks as its size needs,
    so a huge month is several files and a small one a single file. ``derived``: columns of ``df`` that
    others of a row give; they are taken anew behind the exchange instead of being sent.
    """
    derived = dict(derived or {})
    rows = df.drop(*derived).hint("rebalance", *[F.col(c) for c in partition_by]).withColumns(derived).select(*df.columns)
    rows.sortWithinPartitions(*partition_by, *cluster_by).write.mode("overwrite").format(table_format).partitionBy(*partition_by).saveAsTable(table)
    return df.sparkSession.table(table)


def reconcile(target: DataFrame, batch: DataFrame, on_schema_change: str = "append_new_columns") -> tuple[DataFrame, DataFrame]:
    """Both tables with one column set.

    ``append_new_columns`` keeps the target's columns and adds the batch's;
    ``sync_all_columns`` also drops what the batch lacks; ``fail`` insists on
    equal columns; ``ignore`` keeps the target's. The batch's types win.
    """
    old, new = target.columns, batch.columns
    if on_schema_change == "fail":
        if set(old) != set(new):
            raise ValueError(f"columns differ: {sorted(set(old) ^ set(new))}")
        names = old
    elif on_schema_change == "ignore":
        names = old
    elif on_schema_change == "append_new_columns":
        names = old + [c for c in new if c not in old]
    elif on_schema_change == "sync_all_columns":
        names = [c for c in old if c in new] + [c for c in new if c not in old]
    else:
        raise ValueError(f"unknown on_schema_change {on_schema_change!r}")
    kinds = {f.name: f.dataType for f in [*target.schema.fields, *batch.schema.fields]}

    def aligned(df: DataFrame) -> DataFrame:
        own = set(df.columns)
        return df.select([(F.col(f"`{c}`") if c in own else F.lit(None)).cast(kinds[c]).alias(c) for c in names])

    return aligned(target), aligned(batch)


def refuse_duplicates(batch: DataFrame, unique_key: Sequence[str]) -> None:
    """Two rows for one key are an error; missing values are equal here, as everywhere in an upsert."""
    repeated = batch.groupBy(*unique_key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    example = repeated.first()
    if example is not None:
        raise ValueError(f"several batch rows for one key: {example}")


def _without_keys(rows: DataFrame, batch: DataFrame, unique_key: Sequence[str]) -> DataFrame:
    left, right = rows.alias("_rows"), batch.select(*unique_key).alias("_batch")
    return left.join(right, same_keys("_rows", "_batch", unique_key), "left_anti")


def merge_rows(target: DataFrame, batch: DataFrame, unique_key: Sequence[str]) -> DataFrame:
    """Target after updating matched keys, NULLs included, and inserting the others."""
    return _without_keys(target, batch, unique_key).unionByName(batch)


def with_bucket(df: DataFrame, unique_key: Sequence[str], buckets: int) -> DataFrame:
    """Partition column for tables without a natural one: a hash of the key."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in unique_key]), F.lit(buckets)).cast("int"))


def _buckets_of(spark: SparkSession, table: str, wanted: int | None) -> int:
    """The bucket count stored with the table; another one would look for keys in the wrong place."""
    stored = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(BUCKETS_PROPERTY)
    if stored is None:
        raise ValueError(f"{table} does not say how many key buckets it has: set its property {BUCKETS_PROPERTY}")
    if wanted is not None and wanted != int(stored):
        raise ValueError(f"{table} has {stored} key buckets, not {wanted}")
    return int(stored)


def _store_buckets(spark: SparkSession, table: str, count: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{count}')")


def content_order(df: DataFrame, latest_by: str, columns: Sequence[str]) -> Column:
    """What decides between two rows of a key: ``latest_by``, then the content, so that the order of arrival does not."""
    content = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in sorted(columns)])
    return F.struct(F.col(f"`{latest_by}`").alias("latest"), content.alias("content"))


def _not_older(batch: DataFrame, stored: DataFrame, keys: Sequence[str], latest_by: str) -> DataFrame:
    """Rows of the batch whose key has no later row in the table."""
    shared = [c for c in batch.columns if c in stored.columns]
    if latest_by not in shared:
        return batch
    ours = batch.withColumn("_order", content_order(batch, latest_by, shared)).alias("_ours")
    theirs = stored.select(*keys, content_order(stored, latest_by, shared).alias("_order")).alias("_theirs")
    later = same_keys("_ours", "_theirs", keys) & (F.col("_theirs._order") > F.col("_ours._order"))
    return ours.join(theirs, later, "left_anti").drop("_order")


def upsert(
    batch: DataFrame,
    table: str,
    unique_key: Sequence[str] | str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: int | None = None,
    on_schema_change: str = "append_new_columns",
    table_format: str = "parquet",
    latest_by: str | None = None,
    moved: DataFrame | None = None,
    keys_stay: bool = False,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Update matched keys, insert the others, rewriting only touched partitions, once.

    The first run creates the table. A key may occur once per batch; NULLs in keys are equal, so repeating
    a batch changes nothing. Tables without partition columns are split by a hash of the key into
    ``buckets``, a number stored with the table. New columns are added without touching old files.

    With ``latest_by`` a row replaces only rows that are not later, so the result does not depend on the
    order of batches. A row whose partition columns change leaves its old partition: the keys' present
    partitions are looked up in the key and partition columns of the table, or taken from ``moved`` (a
    table with the partition columns), or are the batch's own if ``keys_stay``. ``derived`` as in
    ``write_partitioned``, for the first run.
    """
    spark = batch.sparkSession
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    parts = list(partition_by) or [BUCKET]
    if not spark.catalog.tableExists(table):
        count = buckets or BUCKETS
        rows = batch if partition_by else with_bucket(batch, keys, count)
        created = write_partitioned(rows, table, parts, cluster_by, table_format, derived)
        try:
            refuse_duplicates(created, keys)
        except ValueError:
            spark.sql(f"DROP TABLE {table}")
            raise
        if not partition_by:
            _store_buckets(spark, table, count)
        return spark.table(table).drop(BUCKET)

    count = 0 if partition_by else _buckets_of(spark, table, buckets)
    bucketed = (lambda df: df) if partition_by else (lambda df: with_bucket(df, keys, count))
    rows = materialise(batch, "batch")  # read several times below
    refuse_duplicates(rows, keys)
    target = spark.table(table)
    plain = target.drop(BUCKET)
    aligned_old, aligned_new = reconcile(plain, rows, on_schema_change)
    old_types, new_types = dict(plain.dtypes), dict(aligned_old.dtypes)
    if any(new_types.get(c) != kind for c, kind in old_types.items()):
        # a column goes or changes its type, which files in place cannot
        fresh = _not_older(aligned_new, aligned_old, keys, latest_by) if latest_by else aligned_new
        merged = materialise(bucketed(merge_rows(aligned_old, fresh, keys)), "merged")
        write_partitioned(merged, table, parts, cluster_by, table_format)
        if not partition_by:
            _store_buckets(spark, table, count)
        return spark.table(table).drop(BUCKET)
    added = [c for c in aligned_old.columns if c not in old_types]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {new_types[c]}' for c in added)})")
        target = spark.table(table)

    # partitions to rewrite: those of the batch and those its keys now sit in
    aligned_new = bucketed(aligned_new)
    own = {tuple(r) for r in aligned_new.select(*parts).distinct().collect()}
    touched = set(own)
    if partition_by and not keys_stay:
        if moved is None:
            moved = target.select(*parts, *keys).alias("_t").join(rows.select(*keys).alias("_b"), same_keys("_t", "_b", keys), "left_semi")
        touched |= {tuple(r) for r in moved.select(*parts).distinct().collect()}  # at most the table's partitions
    if not touched:
        return spark.table(table).drop(BUCKET)
    old = target.filter(in_partitions(parts, touched))
    if latest_by:
        aligned_new = materialise(_not_older(aligned_new, old, keys, latest_by), "fresh")
    kept = _without_keys(old, aligned_new, keys)
    left = own | ({tuple(r) for r in kept.select(*parts).distinct().collect()} if touched - own else set())
    merged = kept.unionByName(aligned_new).select(*target.columns).hint("rebalance", *[F.col(p) for p in parts])
    # a dynamic overwrite may read the partitions it replaces: they go when all tasks are done
    insert_overwrite(merged.sortWithinPartitions(*parts, *cluster_by), table)
    emptied = touched - left if touched - own else set()
    drop_partitions(spark, table, parts, emptied)
    return spark.table(table).drop(BUCKET)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a missing partition value


def partitions_of(spark: SparkSession, table: str) -> set[tuple]:
    """Values of the partitions of a table whose partition columns are integers, from the catalog alone."""
    folders = [row[0].split("/") for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    values = [[part.split("=", 1)[1] for part in parts] for parts in folders]
    return {tuple(None if v in (NO_VALUE, "null") else int(v) for v in each) for each in values}


def drop_partitions(spark: SparkSession, table: str, parts: Sequence[str], values: set[tuple]) -> None:
    if not values:
        return
    specs = [", ".join(f"`{p}` = {_literal(v)}" for p, v in zip(parts, each)) for each in sorted(values, key=repr)]
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))
    spark.catalog.refreshTable(table)


def in_partitions(parts: Sequence[str], touched: set[tuple]) -> Column:
    """Rows of the given partitions, in a form that prunes them."""
    if not touched:
        return F.lit(False)
    if len(parts) == 1 and all(v[0] is not None for v in touched):
        return F.col(parts[0]).isin([v[0] for v in touched])
    each = [reduce(Column.__and__, [F.col(p).eqNullSafe(F.lit(v)) for p, v in zip(parts, values)]) for values in touched]
    return reduce(Column.__or__, each)


def partition_rows(df: DataFrame, parts: Sequence[str]) -> Counter:
    """Rows by partition, of which there are no more than the table has."""
    return Counter({tuple(r)[:-1]: r[-1] for r in df.groupBy(*parts).agg(F.count(F.lit(1))).collect()})


def place_of(parts: Sequence[str], unique_key: Sequence[str], sizes: Mapping[tuple, int]) -> Column:
    """Equal for rows that one task is to write: a partition, or a piece by key of one of many rows.

    ``sizes``: rows by partition. An exchange by it serves joins and groups by key as well as the files.
    """
    cut: dict[int, set[tuple]] = {}
    for values, rows in sizes.items():
        cut.setdefault(-(-rows // PIECE_ROWS), set()).add(values)
    pieces = F.lit(1)
    for count, values in cut.items():
        if count > 1:
            pieces = F.when(in_partitions(parts, values), count).otherwise(pieces)
    text = lambda columns: [F.col(c).cast("string") for c in columns]
    return F.xxhash64(*text(parts), F.pmod(F.xxhash64(*text(unique_key)), pieces))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def high_water_mark(target: DataFrame, mark: str):
    """Largest value of ``mark`` in the target, None if it has none."""
    return target.agg(F.max(mark).alias("mark")).first()["mark"]


def newer_than_mark(source: DataFrame, target: DataFrame | None, mark: str) -> DataFrame:
    """Source rows past the target's mark; all of them for an empty target.

    The mark goes in as a literal, so it reaches the scan and prunes files.
    """
    reached = None if target is None else high_water_mark(target, mark)
    return source if reached is None else source.filter(F.col(mark) > F.lit(reached))


def rows_of_affected(df: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """All rows of the keys that occur in ``changed``, NULL included."""
    keys = changed.select(key).distinct()
    return df.alias("d").join(keys.alias("c"), same_keys("d", "c", [key]), "left_semi")
