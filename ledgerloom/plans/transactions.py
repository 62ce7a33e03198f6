"""Transactions with customer context, rolling measures and risk flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import AsOf, date_diff, moment
from ..functions.expressions import banded, business_key, hash_column, surrogate_key
from ..functions.windows import deviation, deviation_parts, rolling_mean
from ..operators.keyed import keyed_windows
from ..operators.ordered import same_keys
from ..operators.percentiles import Targets, exact_percentiles

# Marks over all amounts, and look-back in rows.
MARKS = {"transaction_95th_percentile": 0.95, "transaction_99th_percentile": 0.99, "transaction_75th_percentile": 0.75}
WEEK_ROWS, MONTH_ROWS = 7, 30


# Percentiles of a customer's amounts in the fact table.
CUSTOMER_POINTS = {
    "median_transaction_amount": ("amount_usd", 0.5),
    "p75_transaction_amount": ("amount_usd", 0.75),
    "p90_transaction_amount": ("amount_usd", 0.9),
}
CUSTOMER_FIGURES = ["total_transactions", "total_spend", "avg_spend", "high_value_transactions", *CUSTOMER_POINTS]


def customer_totals() -> dict[str, Column]:
    amount, when = F.col("amount_usd"), F.col("transaction_date")
    return {
        "total_transactions": F.count("transaction_id"),
        "total_spend": F.sum(amount),
        "avg_spend": F.avg(amount),
        "high_value_transactions": F.count_if(amount > 10000),
        "first_transaction_date": F.min(when),
        "last_transaction_date": F.max(when),
    }


def in_order() -> list[Column]:
    """A customer's transactions in time; the id settles equal times."""
    return [F.col("transaction_date").asc(), F.col("transaction_id").asc()]


def with_customer(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    held = accounts.select("account_id", "customer_id", "account_type", F.col("balance_usd").alias("pre_transaction_balance"))
    return transactions.join(held, "account_id", "left")


def customer_counts(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions per customer; counted per account first, so the join is small."""
    per_account = transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("_n"))
    owned = per_account.join(accounts.select("account_id", "customer_id"), "account_id", "left")
    return owned.groupBy("customer_id").agg(F.sum("_n").alias("_n"))


def time_measures(
    rows: DataFrame,
    totals: dict[str, Column] | None = None,
    percentiles: Targets | None = None,
    counts: DataFrame | None = None,
    at_most: DataFrame | int | None = None,
    hot_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Rolling means, running spend and gap per ``customer_id``: what looks back in time only.

    ``rolling_7day_avg`` and ``rolling_30day_avg`` cover that many rows before
    the current one, not days. ``totals`` and ``percentiles`` add figures over
    all rows of the customer.
    """
    amount, when = F.col("amount_usd"), F.col("transaction_date")
    windowed = keyed_windows(
        rows,
        ["customer_id"],
        in_order(),
        framed={
            "rolling_7day_avg": lambda w: rolling_mean(amount, w, WEEK_ROWS),
            "rolling_30day_avg": lambda w: rolling_mean(amount, w, MONTH_ROWS),
            "_previous": lambda w: F.lag(when).over(w),
        },
        running={"cumulative_spend": "amount_usd"},
        totals=totals,
        percentiles=percentiles,
        rows_back=MONTH_ROWS,
        counts=counts,
        at_most=at_most,
        hot_rows=hot_rows,
        partitions=partitions,
    )
    return windowed.withColumn("hours_since_last_transaction", date_diff("_previous", when, "hour")).drop("_previous")


def scored(rows: DataFrame, mean: str, deviation: str) -> DataFrame:
    """Add the z-score of the amount and the risk flag taken from it."""
    score = (F.col("amount_usd") - F.col(mean)) / F.nullif(deviation, F.lit(0.0))
    flag = banded(F.abs("transaction_z_score"), [(3, "Anomaly"), (2, "Suspicious")], "Normal", strict=True)
    return rows.withColumn("transaction_z_score", score).withColumn("transaction_risk_flag", flag)


def rolling_measures(rows: DataFrame, figures: bool = False, **options) -> DataFrame:
    """``time_measures`` with z-score and flag, all over one window.

    ``figures`` keeps the customer's totals and percentiles of the fact table.
    """
    totals = customer_totals()
    if not figures:
        totals = {"avg_spend": totals["avg_spend"]}
    parts = deviation_parts("amount_usd")
    measured = time_measures(rows, {**totals, **parts}, CUSTOMER_POINTS if figures else None, **options)
    out = scored(measured.withColumn("spend_deviation", deviation()), "avg_spend", "spend_deviation").drop("spend_deviation", *parts)
    return out if figures else out.drop("avg_spend")


def enriched_rows(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    size: int | None = None,
    hot_rows: int | None = None,
    partitions: int | None = None,
    scores: bool = True,
    figures: bool = False,
) -> DataFrame:
    """Everything about a transaction that depends on its own customer only.

    ``size``: a bound on the number of transactions, if known. Without
    ``scores`` a row depends on the customer's rows up to its own time only;
    ``figures`` adds the customer's totals and percentiles.

    The merchant and account joins come first: the windows and the customer
    join then share one distribution by customer.
    """
    shops = merchants.select("merchant_id", "merchant_name", F.col("city").alias("merchant_city"))
    located = with_customer(transactions.join(shops, "merchant_id", "left"), accounts)
    counts = customer_counts(transactions, accounts)
    options = dict(counts=counts, at_most=transactions if size is None else size, hot_rows=hot_rows, partitions=partitions)
    measured = rolling_measures(located, figures, **options) if scores else time_measures(located, **options)
    people = customers.select("customer_id", "first_name", "last_name", "credit_score", "credit_rating", "customer_tier")
    joined = measured.join(people, "customer_id", "left")
    return joined.select(
        surrogate_key(["transaction_id", "customer_id"]).alias("transaction_sk"),
        "transaction_id",
        "account_id",
        "customer_id",
        "account_type",
        "pre_transaction_balance",
        (F.col("pre_transaction_balance") - F.col("amount_usd")).alias("post_transaction_balance"),
        "merchant_id",
        "merchant_name",
        "merchant_city",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "credit_score",
        "credit_rating",
        "customer_tier",
        "amount_usd",
        "transaction_date",
        "transaction_year",
        "transaction_month",
        "transaction_quarter",
        "transaction_dayofweek",
        "transaction_size",
        "time_of_day",
        "day_type",
        "is_holiday",
        "rolling_7day_avg",
        "rolling_30day_avg",
        *(["transaction_z_score", "transaction_risk_flag"] if scores else []),
        "cumulative_spend",
        "hours_since_last_transaction",
        *([*CUSTOMER_FIGURES, "first_transaction_date", "last_transaction_date"] if figures else []),
    )


def amount_marks(transactions: DataFrame, size: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """One row of percentiles over all amounts."""
    points = {n: ("amount_usd", p) for n, p in MARKS.items()}
    return exact_percentiles(transactions, [], points, at_most=size, hot_rows=hot_rows)


def with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Percentiles and the value category taken from them.

    Kept apart from ``enriched_rows`` because new transactions move them for
    old rows too: an incremental table stores the rows and joins these on read.
    """
    amount = F.col("amount_usd")
    category = F.when(amount > F.col("transaction_95th_percentile"), "High Value").when(
        amount > F.col("transaction_75th_percentile"), "Above Average"
    )
    return rows.crossJoin(F.broadcast(marks)).withColumn("value_category", category.otherwise("Normal"))


def transaction_enriched(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    size: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per transaction, from the staged tables."""
    size = transactions.count() if size is None else size
    rows = enriched_rows(transactions, accounts, customers, merchants, size, hot_rows)
    return with_marks(rows, amount_marks(transactions, size, hot_rows))


def customer_stats(rows: DataFrame, counts: DataFrame | None = None, size: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """One row per ``customer_id``: totals, percentiles and deviation of its amounts."""
    parts = deviation_parts("amount_usd")
    found = exact_percentiles(rows, ["customer_id"], CUSTOMER_POINTS, {**customer_totals(), **parts}, counts, size, hot_rows)
    return found.withColumn("spend_deviation", deviation()).drop(*parts)


def _as_facts(rows: DataFrame, as_of: AsOf) -> DataFrame:
    """Velocity, keys and hashes on rows that hold the customer's totals."""
    months = date_diff("first_transaction_date", "last_transaction_date", "month")
    velocity = F.round(F.col("total_transactions") / F.nullif(months, F.lit(0).cast("bigint")), 2)
    rows = rows.withColumn("transactions_per_month", velocity).drop("first_transaction_date", "last_transaction_date")
    # transactions without a customer get no customer figures
    known = F.col("customer_id").isNotNull()
    return rows.withColumns(
        {
            **{n: F.when(known, F.col(n)) for n in [*CUSTOMER_FIGURES, "transactions_per_month"]},
            "period_customer_key": business_key(["transaction_year", "transaction_month", "customer_id"]),
            "transaction_hash": hash_column(
                F.concat(*[F.col(c).cast("string") for c in ("transaction_id", "amount_usd", "transaction_date")])
            ),
            "dbt_updated_at": moment(as_of),
        }
    )


def with_scores(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Scores from stored customer statistics instead of a window."""
    own = stats.select("customer_id", F.col("avg_spend").alias("_mean"), F.col("spend_deviation").alias("_deviation"))
    joined = rows.alias("r").join(own.alias("s"), same_keys("r", "s", ["customer_id"]), "left").select("r.*", "_mean", "_deviation")
    return scored(joined, "_mean", "_deviation").drop("_mean", "_deviation")


def facts_from_stats(enriched: DataFrame, stats: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The fact table's rows from stored customer statistics instead of a window."""
    rows = enriched.drop("hours_since_last_transaction", "transaction_75th_percentile")
    rows = rows.withColumnRenamed("cumulative_spend", "cumulative_customer_spend")
    own = stats.drop("spend_deviation")
    joined = rows.alias("r").join(own.alias("s"), same_keys("r", "s", ["customer_id"]), "left")
    return _as_facts(joined.select("r.*", *[f"s.{c}" for c in own.columns if c != "customer_id"]), as_of)


def fct_transactions(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    as_of: AsOf = None,
    size: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """The transaction fact table, from the staged tables.

    Enriched rows and customer figures come from one pass over the customers.
    """
    size = transactions.count() if size is None else size
    rows = enriched_rows(transactions, accounts, customers, merchants, size, hot_rows, figures=True)
    marked = with_marks(rows, amount_marks(transactions, size, hot_rows))
    marked = marked.drop("hours_since_last_transaction", "transaction_75th_percentile")
    return _as_facts(marked.withColumnRenamed("cumulative_spend", "cumulative_customer_spend"), as_of)
