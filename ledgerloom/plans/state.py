"""A stored digest of the transactions, month by month, which refreshes read instead of the history.

One row per customer, month and amount, partitioned like the transactions: how often the amount occurs, and the
sums of these rows; a month of very many rows is digested in pieces, each with rows of its own. The sums add up
to those of all time, and counted amounts give exact percentiles. A month's digest is taken from its rows alone,
so the months that a batch rewrites are digested again and no other; nothing is ever subtracted. ``transaction_year``
and ``transaction_month`` must be those of ``transaction_date``.

``open_state`` marks the table before transactions are written and ``renew`` ends that, so a run that was lost
between the two is seen by the next one, which digests all months again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.windows import deviation, deviation_parts
from ..operators.ordered import fitting, same_keys
from ..operators.percentiles import exact_percentiles
from ..sources.registry import insert_overwrite
from ..sources.tables import drop_partitions, in_partitions, partition_rows, partitions_of, place_of, rows_of_affected
from .transactions import CUSTOMER_POINTS, customer_totals

PARTITIONS = ("transaction_year", "transaction_month")
SUMMED = ("total_transactions", "total_spend", "high_value_transactions", "_n", "_sum", "_squares")
OPEN_PROPERTY = "ledgerloom.open"


def state_table(name: str) -> str:
    return f"{name}_state"


def digest(rows: DataFrame) -> DataFrame:
    """Per customer, month and amount: the rows, and the sums that figures over all time are made of.

    One exchange, by the month or the piece of it, after which the rows are where they are written.
    """
    sums = {n: c for n, c in customer_totals().items() if n != "avg_spend"} | deviation_parts("amount_usd")
    own = rows.select("transaction_id", "customer_id", "amount_usd", "transaction_date", *PARTITIONS)
    placed = own.withColumn("_place", place_of(PARTITIONS, ["transaction_id"], partition_rows(rows, PARTITIONS))).repartition("_place")
    grouped = placed.groupBy("_place", "customer_id", "amount_usd", *PARTITIONS)
    found = grouped.agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in sums.items()])
    return found.drop("_place").sortWithinPartitions(*PARTITIONS, "customer_id")


def _set_open(spark: SparkSession, state: str, value: bool) -> None:
    spark.sql(f"ALTER TABLE {state} SET TBLPROPERTIES ('{OPEN_PROPERTY}' = '{str(value).lower()}')")


def _left_open(spark: SparkSession, state: str) -> bool:
    return any(r[0] == OPEN_PROPERTY and r[1] == "true" for r in spark.sql(f"SHOW TBLPROPERTIES {state}").collect())


def open_state(spark: SparkSession, table: str, name: str) -> None:
    """Say that transactions are about to be written; first mend what a lost run left open."""
    state = state_table(name)
    if not spark.catalog.tableExists(state) or _left_open(spark, state):
        renew(spark, table, name, partitions_of(spark, table))
    _set_open(spark, state, True)


def renew(spark: SparkSession, table: str, name: str, months: set[tuple]) -> None:
    """Digest the given months of ``table``, or all if there is no digest, and drop digests of months that are gone."""
    state, rows = state_table(name), spark.table(table)
    if not spark.catalog.tableExists(state):
        digest(rows).write.mode("overwrite").format("parquet").partitionBy(*PARTITIONS).saveAsTable(state)
    else:
        present = partitions_of(spark, table)
        drop_partitions(spark, state, PARTITIONS, partitions_of(spark, state) - present)
        if months & present:
            insert_overwrite(digest(rows.filter(in_partitions(PARTITIONS, months & present))), state)
    _set_open(spark, state, False)


def reached_months(spark: SparkSession, name: str, starts: DataFrame, rows_back: int) -> DataFrame:
    """The months in which a customer has rows that a change reaches, or one of the ``rows_back`` rows before.

    ``starts`` has ``customer_id``, the time ``_from`` of the first change and ``_all`` if every row changes.
    Rows without time are the oldest. Of the month of the first change itself no row counts as one before.
    """
    months = spark.table(state_table(name)).groupBy("customer_id", *PARTITIONS).agg(F.sum("_rows").alias("_rows"))
    joined = months.alias("m").join(starts.alias("c"), same_keys("m", "c", ["customer_id"]))
    gap = (F.col("transaction_year") - F.year("_from")) * 12 + F.col("transaction_month") - F.month("_from")
    own = joined.select("m.customer_id", *PARTITIONS, "_rows", "_from", "_all", gap.alias("_gap"))
    newer = Window.partitionBy("customer_id").orderBy(F.col("_gap").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    between = F.coalesce(F.sum(F.when(F.col("_gap") < 0, F.col("_rows"))).over(newer), F.lit(0))
    wanted = own.withColumn("_between", between).filter(F.col("_all") | (F.col("_gap") >= 0) | (F.col("_between") < rows_back))
    return wanted.drop("_rows", "_gap", "_between")


def stats_from_state(stored: DataFrame, name: str, changed: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """``customer_stats`` of the customers in ``changed``, or of all, from the digest.

    A few customers are looked up in the digest before it is grouped. Many are after it: a group is sent
    in less than its rows are.
    """
    spark = stored.sparkSession
    kinds = dict(stored.groupBy("customer_id").agg(*[c.alias(n) for n, c in customer_totals().items()]).dtypes)
    own = spark.table(state_table(name)).drop(*PARTITIONS)
    few = False
    if changed is not None:
        ids = changed.select("customer_id").distinct()
        near = fitting(ids, changed.count())
        few = near is not ids
        own = own.alias("d").join(near.alias("c"), same_keys("d", "c", ["customer_id"]), "left_semi") if few else own
    totals = {n: F.sum(n) for n in SUMMED} | {"first_transaction_date": F.min("first_transaction_date"), "last_transaction_date": F.max("last_transaction_date")}
    found = exact_percentiles(own, ["customer_id"], CUSTOMER_POINTS, totals, at_most=spark.table(state_table(name)), hot_rows=hot_rows, weight="_rows")
    found = found.withColumn("total_spend", F.col("total_spend").cast(kinds["total_spend"])).withColumn("avg_spend", _mean(kinds))
    rows = found.withColumn("spend_deviation", deviation())
    if changed is not None and not few:
        rows = rows_of_affected(rows, changed, "customer_id")
    return rows.select("customer_id", *customer_totals(), *CUSTOMER_POINTS, "spend_deviation")


def _mean(kinds: dict[str, str]) -> Column:
    """The mean as the aggregate rounds it: a decimal sum by a decimal count."""
    count = F.nullif(F.col("_n"), F.lit(0).cast("bigint"))
    exact = kinds["total_spend"].startswith("decimal")
    return (F.col("total_spend") / (count.cast("decimal(20,0)") if exact else count)).cast(kinds["avg_spend"])
