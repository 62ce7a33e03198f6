"""Incremental refresh of the stored tables.

A batch holds new transactions and amended ones (a known ``transaction_id`` with other values). Running and
rolling figures look back in time, so it changes them for a customer's rows from the earliest changed one on,
where both the old and the new time and owner of an amended row count. Only those rows are written again,
which for a batch in order means the newest partitions. Their look-back, 30 rows and a running sum, is read
from the stored rows; nothing before is windowed again. Stored sums per customer and month (``state``) say in
which months those rows are, and only these partitions are read.

Figures over all rows of a customer go to a table of one row per customer; for the batch's customers they are
taken again from the stored sums and counted amounts of the months, not from the transactions. To find amended
rows the ids of the table are read, unless ``only_new`` says that there are none. Figures over the whole table
are not stored at all. Both are joined on read. Any number of batches, late and amended rows included, gives the result of one full run.

Accounts, customers and merchants are taken as they are when a transaction is written: a change of theirs
is not carried to rows already stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.casts import AsOf
from ..functions.expressions import surrogate_key
from ..operators.ordered import same_keys
from ..session import materialise, setting
from ..sources.registry import insert_overwrite
from ..sources.tables import drop_partitions, in_partitions, partition_rows, place_of, refuse_duplicates, rows_of_affected, upsert, write_partitioned
from . import state
from .accounts import balance_marks, summary_rows, with_balance_marks
from .analytics import clv_analysis
from .transactions import MONTH_ROWS, amount_marks, enriched_rows, facts_from_stats, time_measures, with_customer, with_marks, with_scores

PARTITIONS = state.PARTITIONS
CLUSTER = ("customer_id", "transaction_date")
STATS_KEY = "stats_sk"
KEY = "transaction_id"
# what looking back reads of a row
LOOKED_AT = (KEY, "customer_id", "amount_usd", "transaction_date", "cumulative_spend", *PARTITIONS)
CODEC = "zstd"  # of the stored tables, which every batch writes again
LOOK_BACK = ("rolling_7day_avg", "rolling_30day_avg", "cumulative_spend", "hours_since_last_transaction")


def derived() -> dict[str, Column]:
    """Columns that others of a row give."""
    return {
        "transaction_sk": surrogate_key([KEY, "customer_id"]),
        "post_transaction_balance": F.col("pre_transaction_balance") - F.col("amount_usd"),
    }


def replaced_rows(table: str, batch: DataFrame) -> DataFrame:
    """What the table holds for the transactions of ``batch``: none before the first run."""
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        return enriched_shape(batch).limit(0)
    known, ids = spark.table(table).alias("k"), batch.select("transaction_id").alias("b")
    return known.join(ids, same_keys("k", "b", ["transaction_id"]), "left_semi")


def enriched_shape(batch: DataFrame) -> DataFrame:
    """The columns of a replaced row that refreshes look at."""
    nothing = F.lit(None).cast("string")
    return batch.select("transaction_id", "account_id", nothing.alias("customer_id"), "transaction_date", *PARTITIONS)


def changed_from(changed: DataFrame) -> DataFrame:
    """Per customer, the time of the first row that a batch can change.

    Rows without time come first of all, so one of them changes every row.
    """
    when = F.col("transaction_date")
    return changed.groupBy("customer_id").agg(F.min(when).alias("_from"), F.bool_or(when.isNull()).alias("_all"))


def _reached(first: str = "") -> Column:
    """Rows that a change of their customer touches."""
    return F.col("_all") | (F.col(f"{first}transaction_date") >= F.col("_from"))


def _months(rows: DataFrame) -> set[tuple]:
    """The months that occur, of which there are no more than partitions."""
    return {tuple(r) for r in rows.select(*PARTITIONS).distinct().collect()}


def reached_rows(stored: DataFrame, reached: DataFrame) -> DataFrame:
    """Stored rows of the customers and months in ``reached``; no other partition is read."""
    near, keys = stored.filter(in_partitions(PARTITIONS, _months(reached))), ["customer_id", *PARTITIONS]
    return near.alias("r").join(reached.alias("c"), same_keys("r", "c", keys)).select("r.*", "_from", "_all")


def _tails(stored: DataFrame, fresh: DataFrame, reached: DataFrame) -> DataFrame:
    """Stored and fresh rows from each customer's first change on, and those before that they look back to.

    Only the columns that looking back reads: the others of a row stay where they are until it is written.
    """
    rows = reached_rows(stored.select(*LOOKED_AT), reached).withColumn("_later", F.coalesce(_reached(), F.lit(False))).drop("_from", "_all")
    own = rows.alias("s").join(fresh.select(KEY).alias("f"), same_keys("s", "f", [KEY]), "left_anti")
    marked = lambda df, write, new: df.withColumn("_write", F.lit(write)).withColumn("_fresh", F.lit(new))
    # the rows just before: enough for the rolling means, and the running sum so far
    newest = Window.partitionBy("customer_id").orderBy(F.col("transaction_date").desc(), F.col(KEY).desc())
    before = own.filter(~F.col("_later")).withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= MONTH_ROWS)
    later, before = own.filter("_later").drop("_later"), before.drop("_later", "_back")
    rows = marked(later, True, False).unionByName(marked(fresh.select(*LOOKED_AT), True, True)).unionByName(marked(before, False, False))
    return materialise(rows, "tails")


def _look_back(stored: DataFrame, rows: DataFrame, hot_rows: int | None) -> DataFrame:
    """Keys, places and renewed look-back figures of the rows to write of ``_tails``."""
    # what the rows before the oldest one read had spent
    first = F.when(~F.col("_write"), F.struct("transaction_date", KEY))
    base = F.min_by(F.col("_spent") - F.coalesce("amount_usd", F.lit(0)), first)
    measured = time_measures(rows.withColumnRenamed("cumulative_spend", "_spent"), {"_base": base}, hot_rows=hot_rows).filter("_write")
    # a running sum stays NULL until its first value
    total = F.coalesce(F.col("cumulative_spend") + F.coalesce("_base", F.lit(0)), F.col("_base"))
    kind = stored.schema["cumulative_spend"].dataType
    return measured.withColumn("cumulative_spend", total.cast(kind)).select(KEY, *PARTITIONS, "_fresh", *LOOK_BACK)


def _merged(stored: DataFrame, fresh: DataFrame, measures: DataFrame, gone: DataFrame, sizes: dict[tuple, int]) -> DataFrame:
    """Stored and fresh rows with the look-back figures of ``measures``, without the stored rows in ``gone``.

    One exchange takes the rows to where they are written, and their changes to them.
    """
    place = place_of(PARTITIONS, [KEY], sizes)
    nothing = [F.lit(None).alias(n) for n in LOOK_BACK]
    dropped = gone.select(KEY, *PARTITIONS, F.lit(False).alias("_fresh"), *nothing, F.lit(True).alias("_gone"))
    changes = measures.withColumn("_gone", F.lit(False)).unionByName(dropped).withColumn("_place", place).drop(*PARTITIONS)
    rows = stored.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True))).drop(*derived()).withColumn("_place", place)
    same = (F.col("r._place") == F.col("c._place")) & (F.col("r._fresh") == F.col("c._fresh")) & same_keys("r", "c", [KEY])
    joined = rows.repartition("_place").alias("r").join(changes.repartition("_place").alias("c"), same, "left")
    kept = joined.filter(~F.coalesce(F.col("c._gone"), F.lit(False)))
    renewed = {n: F.when(F.col("c._gone").isNotNull(), F.col(f"c.{n}")).otherwise(F.col(f"r.{n}")) for n in LOOK_BACK}
    return kept.select(*[renewed.get(n, F.col(f"r.{n}")).alias(n) for n in stored.columns if n not in derived()]).withColumns(derived()).select(*stored.columns)


def _write(table: str, stored: DataFrame, fresh: DataFrame, measures: DataFrame, old: DataFrame, months: set[tuple], only_new: bool) -> DataFrame:
    """Rewrite the given months with fresh rows, renewed figures and without the rows replaced."""
    spark = stored.sparkSession
    near = stored.filter(in_partitions(PARTITIONS, months))
    sizes = partition_rows(near, PARTITIONS) + partition_rows(fresh, PARTITIONS)
    gone = fresh if only_new else old
    # the exchange by place is enough for the join, whose other keys lie within it
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        merged = _merged(near, fresh, measures, gone, sizes)
        if merged.dtypes != stored.dtypes:  # a column changes its type, which files in place cannot
            whole = materialise(_merged(stored, fresh, measures, gone, partition_rows(stored, PARTITIONS) + partition_rows(fresh, PARTITIONS)), "merged")
            return write_partitioned(whole, table, PARTITIONS, CLUSTER, derived=derived())
        insert_overwrite(merged.sortWithinPartitions(*PARTITIONS, *CLUSTER), table)
    left = sizes if only_new else sizes - partition_rows(old, PARTITIONS)
    drop_partitions(spark, table, PARTITIONS, {m for m in months if left[m] <= 0})
    return spark.table(table)


def refresh_transactions(
    table: str,
    stats_table: str,
    batch: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    hot_rows: int | None = None,
    only_new: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``batch``: new and amended staged transactions. Returns the stored rows and the statistics per customer.

    ``only_new``: no transaction of the batch is stored yet, so none is looked for. The digest of the months lies
    in a table named after ``stats_table``.
    """
    with setting(batch.sparkSession, "spark.sql.parquet.compression.codec", CODEC):
        return _refreshed(table, stats_table, batch, accounts, customers, merchants, hot_rows, only_new)


def _refreshed(
    table: str,
    stats_table: str,
    batch: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    hot_rows: int | None,
    only_new: bool,
) -> tuple[DataFrame, DataFrame]:
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        rows = enriched_rows(batch, accounts, customers, merchants, batch.count(), hot_rows, scores=False)
        stored = upsert(rows, table, KEY, PARTITIONS, CLUSTER, derived=derived())
        changed, months = None, set()
    else:
        stored = spark.table(table)
        batch = materialise(batch, "batch")
        fresh = materialise(enriched_rows(batch, accounts, customers, merchants, batch.count(), hot_rows, scores=False), "fresh")
        refuse_duplicates(fresh, [KEY])
        state.open_state(spark, table, stats_table)
        known = enriched_shape(batch).limit(0) if only_new else replaced_rows(table, batch)
        old = materialise(known.select("transaction_id", "customer_id", "transaction_date", *PARTITIONS), "replaced")
        changed = materialise(old.select("customer_id", "transaction_date").unionByName(fresh.select("customer_id", "transaction_date")), "changed")
        reached = materialise(state.reached_months(spark, stats_table, changed_from(changed), MONTH_ROWS), "reached")
        tails = _tails(stored, fresh, reached)
        months = _months(tails.filter("_write")) | _months(old)
        if months:
            stored = _write(table, stored, fresh, _look_back(stored, tails, hot_rows), old, months, only_new)
    state.renew(spark, table, stats_table, months)
    if changed is None:
        stats = state.stats_from_state(stored, stats_table, None, hot_rows)
        return stored, upsert(stats.withColumn(STATS_KEY, surrogate_key(["customer_id"])), stats_table, STATS_KEY).drop(STATS_KEY)
    stats = state.stats_from_state(stored, stats_table, changed.select("customer_id"), hot_rows)
    gone = changed.select("customer_id").distinct().alias("c").join(stats.select("customer_id").alias("s"), same_keys("c", "s", ["customer_id"]), "left_anti")
    stats = stats.unionByName(gone, allowMissingColumns=True).withColumn(STATS_KEY, surrogate_key(["customer_id"]))
    return stored, upsert(stats, stats_table, STATS_KEY).drop(STATS_KEY)


def read_enriched(stored: DataFrame, stats: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The enriched transactions of today."""
    rows = with_scores(stored.drop(*derived()), stats).withColumns(derived())
    ordered = rows.select(*stored.columns, *[c for c in rows.columns if c not in stored.columns])
    return with_marks(ordered, amount_marks(stored, hot_rows=hot_rows))


def read_facts(stored: DataFrame, stats: DataFrame, as_of: AsOf = None, hot_rows: int | None = None) -> DataFrame:
    """The fact table of today."""
    return facts_from_stats(read_enriched(stored, stats, hot_rows), stats, as_of)


def refresh_accounts(
    table: str,
    batch: DataFrame,
    history: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    as_of: AsOf = None,
    hot_rows: int | None = None,
    replaced: DataFrame | None = None,
) -> DataFrame:
    """Accounts with new or amended transactions, and accounts not stored yet.

    ``history``: all transactions as they are now; ``replaced``: the rows that the batch amended, as they were
    (``replaced_rows``), since an account that lost one changes too.
    """
    spark = batch.sparkSession
    changed = batch.select("account_id")
    if replaced is not None:
        changed = changed.unionByName(replaced.select("account_id"))
    if spark.catalog.tableExists(table):
        known = spark.table(table).select("account_id")
        changed = changed.unionByName(accounts.select("account_id").join(known, "account_id", "left_anti"))
    else:
        changed = accounts.select("account_id")
    changed = materialise(changed.distinct(), "changed")
    owned = rows_of_affected(accounts, changed, "account_id")
    moved = rows_of_affected(history, changed, "account_id")
    return upsert(summary_rows(owned, customers, moved, as_of, hot_rows=hot_rows), table, "account_id")


def read_accounts(stored: DataFrame, accounts: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The stored rows with today's percentiles over all balances."""
    return with_balance_marks(stored, balance_marks(accounts, hot_rows))


def refresh_clv(
    table: str,
    batch: DataFrame,
    facts: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    as_of: AsOf = None,
    replaced: DataFrame | None = None,
) -> DataFrame:
    """``facts``: the stored transactions after their own refresh; ``replaced``: as they were before it.

    A customer left without transactions keeps a row without figures, which ``read_clv`` passes over.
    """
    changed = with_customer(batch, accounts).select("customer_id")
    if replaced is not None:
        changed = changed.unionByName(replaced.select("customer_id"))
    changed = materialise(changed.filter("customer_id IS NOT NULL").distinct(), "changed")
    known = clv_analysis(rows_of_affected(facts, changed, "customer_id"), customers, as_of)
    gone = changed.join(known.select("customer_id"), "customer_id", "left_anti")
    return upsert(known.unionByName(gone, allowMissingColumns=True), table, "customer_id")


def read_clv(stored: DataFrame) -> DataFrame:
    return stored.filter("total_transactions IS NOT NULL")
