"""Account summary with activity and health."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import AsOf, age_years, date_diff, moment
from ..functions.expressions import banded, hash_column, ladder
from ..functions.windows import share_percent
from ..operators.percentiles import exact_percentiles

# Lower ends (exclusive) of the activity bands.
ACTIVITY = [(50, "Very Active"), (20, "Active"), (5, "Moderate")]


def transaction_metrics(transactions: DataFrame, size: int | None = None, hot_rows: int | None = None) -> DataFrame:
    amount, when = F.col("amount_usd"), F.col("transaction_date")
    sums = exact_percentiles(
        transactions,
        ["account_id"],
        {"median_transaction_amount": ("amount_usd", 0.5)},
        aggregates={
            "transaction_count": F.count("transaction_id"),
            "total_transaction_amount": F.sum(amount),
            "avg_transaction_amount": F.avg(amount),
            "min_transaction_amount": F.min(amount),
            "max_transaction_amount": F.max(amount),
            "first_transaction_date": F.min(when),
            "last_transaction_date": F.max(when),
            "distinct_merchants": F.count_distinct("merchant_id"),
            "high_value_transactions": F.count_if(amount > 10000),
        },
        at_most=transactions if size is None else size,
        hot_rows=hot_rows,
    )
    first, last = F.col("first_transaction_date"), F.col("last_transaction_date")
    months = F.nullif(date_diff(first, last, "month"), F.lit(0).cast("bigint"))
    return sums.withColumns(
        {
            "transaction_span_days": date_diff(first, last, "day"),
            "transactions_per_month": F.col("transaction_count") / months,
        }
    )


def summary_rows(
    accounts: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    as_of: AsOf = None,
    size: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Everything about an account that depends on its own rows only.

    ``size``: a bound on the number of transactions, if known.
    """
    now = moment(as_of)
    people = customers.select("customer_id", "first_name", "last_name", "credit_score", "credit_rating", "customer_tier")
    joined = accounts.join(people, "customer_id", "left").join(transaction_metrics(transactions, size, hot_rows), "account_id", "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    balance, count, age = F.col("balance_usd"), zero("transaction_count"), age_years("open_date", as_of)
    total = F.col("total_transaction_amount")
    turnover = F.when(total > 0, F.round(share_percent(total, balance), 2)).otherwise(F.lit(0))
    health = ladder(
        [
            (count == 0, "Dormant"),
            (balance < 0, "Overdrawn"),
            ((age > 5) & (count > 100), "Mature Active"),
            ((age > 5) & (count <= 100), "Mature Low Activity"),
        ],
        "Standard",
    )
    return joined.select(
        "account_id",
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "credit_score",
        "credit_rating",
        "customer_tier",
        "account_type",
        balance.alias("current_balance"),
        "open_date",
        "open_year",
        "open_month",
        age.alias("account_age_years"),
        date_diff("open_date", now, "month").alias("account_age_months"),
        count.alias("transaction_count"),
        *[zero(c).alias(c) for c in ("total_transaction_amount", "avg_transaction_amount", "median_transaction_amount")],
        *[zero(c).alias(c) for c in ("min_transaction_amount", "max_transaction_amount")],
        "first_transaction_date",
        "last_transaction_date",
        zero("distinct_merchants").alias("distinct_merchants"),
        zero("high_value_transactions").alias("high_value_transactions"),
        zero("transactions_per_month").alias("avg_transactions_per_month"),
        banded(count, ACTIVITY, "Inactive", strict=True).alias("activity_level"),
        turnover.alias("turnover_ratio"),
        health.alias("account_health_status"),
        hash_column(F.concat(*[c.cast("string") for c in (F.col("account_id"), balance, now)])).alias("account_snapshot_hash"),
        now.alias("dbt_updated_at"),
    )


def balance_marks(accounts: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One row of percentiles over all balances."""
    points = {"balance_90th_percentile": ("balance_usd", 0.9), "balance_median": ("balance_usd", 0.5)}
    return exact_percentiles(accounts, [], points, hot_rows=hot_rows)


def with_balance_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Balance percentiles and category; apart, since they move for old rows too."""
    balance = F.col("current_balance")
    category = F.when(balance > F.col("balance_90th_percentile"), "High Balance").when(
        balance > F.col("balance_median"), "Medium Balance"
    )
    return rows.crossJoin(F.broadcast(marks)).withColumn("balance_category", category.otherwise("Low Balance"))


def account_summary(
    accounts: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    as_of: AsOf = None,
    size: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per account, from the staged tables."""
    rows = summary_rows(accounts, customers, transactions, as_of, size, hot_rows)
    return with_balance_marks(rows, balance_marks(accounts, hot_rows))
