"""Customer 360, cards per customer and the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import AsOf, date_diff, moment
from ..functions.expressions import business_key, hash_column, ladder, surrogate_key
from ..operators.ordered import global_rank_ntile
from ..session import materialise

# Quintile 1 is the richest.
WEALTH_LABELS = {1: "Top 20%", 2: "Upper Middle 20%", 3: "Middle 20%", 4: "Lower Middle 20%"}


def account_totals(accounts: DataFrame) -> DataFrame:
    balance = F.col("balance_usd")
    return accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("total_accounts"),
        F.sum(balance).alias("total_balance_usd"),
        F.avg(balance).alias("avg_account_balance"),
        F.max(balance).alias("max_account_balance"),
        F.min(balance).alias("min_account_balance"),
        # a handful of account types, sorted for a repeatable result
        F.array_join(F.sort_array(F.collect_set("account_type")), ", ").alias("account_types"),
    )


def loan_totals(loans: DataFrame) -> DataFrame:
    """Open loans only."""
    amount = F.col("loan_amount")
    return (
        loans.filter(F.col("loan_status") != "Completed")
        .groupBy("customer_id")
        .agg(
            F.count("loan_id").alias("total_loans"),
            F.sum(amount).alias("total_loan_amount"),
            F.avg("interest_rate").alias("avg_interest_rate"),
            F.max(amount).alias("max_loan_amount"),
            F.sum(amount).alias("total_loan_balance"),
        )
    )


def card_totals(cards: DataFrame, accounts: DataFrame) -> DataFrame:
    """Cards per customer, counted per account before the join to keep it narrow."""
    expired = F.col("is_expired")
    per_account = (
        cards.filter(F.col("card_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count("card_id").alias("total_cards"),
            F.count_if(F.col("card_type") == "Credit").alias("credit_cards"),
            F.count_if(F.col("card_type") == "Debit").alias("debit_cards"),
            F.count_if(expired).alias("expired_cards"),
            F.count_if((F.col("months_until_expiry") <= 3) & ~expired).alias("cards_expiring_soon"),
        )
    )
    sums = ["total_cards", "credit_cards", "debit_cards", "expired_cards", "cards_expiring_soon"]
    owned = per_account.join(accounts.select("account_id", "customer_id"), "account_id", "left")
    return owned.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in sums])


def wealth_scores(totals: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rank, quintile and 90th percentile of the balance over all account holders.

    All three come from one distributed sort. The percentile is that of the
    balance, under the name its users know.
    """
    held = totals.select("customer_id", "total_balance_usd")
    return global_rank_ntile(
        held, "total_balance_usd", "customer_id", 5, "balance_rank", "wealth_quintile", {"credit_score_90th_percentile": 0.9}, partitions
    ).drop("total_balance_usd")


def customer_360(
    customers: DataFrame, accounts: DataFrame, loans: DataFrame, cards: DataFrame, partitions: int | None = None
) -> DataFrame:
    """One row per customer, from the staged tables."""
    totals = materialise(account_totals(accounts), "totals")  # counted, sorted and joined below
    scores = wealth_scores(totals, partitions)
    joined = (
        customers.alias("c")
        .join(totals.alias("a"), F.col("c.customer_id") == F.col("a.customer_id"), "left")
        .join(loan_totals(loans).alias("l"), F.col("c.customer_id") == F.col("l.customer_id"), "left")
        .join(card_totals(cards, accounts).alias("d"), F.col("c.customer_id") == F.col("d.customer_id"), "left")
        .join(scores.alias("s"), F.col("c.customer_id") == F.col("s.customer_id"), "left")
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    balance, debt = zero("a.total_balance_usd"), zero("l.total_loan_amount")
    health = ladder([(balance > debt * 1.5, "Excellent"), (balance > debt, "Good"), (balance > debt * 0.5, "Fair")], "Needs Attention")
    return joined.select(
        "c.customer_id",
        "c.first_name",
        "c.last_name",
        "c.email_masked",
        F.col("c.city").alias("customer_city"),
        "c.credit_score",
        "c.credit_rating",
        "c.customer_tier",
        "c.customer_age_years",
        "c.created_at",
        zero("a.total_accounts").alias("total_accounts"),
        balance.alias("total_balance_usd"),
        zero("a.avg_account_balance").alias("avg_account_balance"),
        "a.account_types",
        zero("l.total_loans").alias("total_loans"),
        debt.alias("total_loan_amount"),
        zero("l.avg_interest_rate").alias("avg_interest_rate"),
        *[zero(f"d.{c}").alias(c) for c in ("total_cards", "credit_cards", "debit_cards", "expired_cards", "cards_expiring_soon")],
        (balance - debt).alias("net_worth"),
        # assets over debt, in spite of its name
        F.round(F.try_divide(balance, F.nullif(debt, F.lit(0))), 2).alias("debt_to_asset_ratio"),
        "s.credit_score_90th_percentile",
        "s.balance_rank",
        "s.wealth_quintile",
        surrogate_key(["c.customer_id", "c.created_at"]).alias("customer_sk"),
        business_key(["c.first_name", "c.last_name", "c.email_masked"]).alias("customer_business_key"),
        health.alias("financial_health_status"),
    )


def customer_card_info(customers: DataFrame, accounts: DataFrame, cards: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Customer x account x card, customers without either included."""
    holder = customers.select("customer_id", "first_name", "last_name", "email_masked", "credit_score", "credit_rating")
    held = accounts.select("customer_id", "account_id", "account_type", "balance_usd")
    issued = cards.select("account_id", "card_id", "card_type", "expiration_date", "is_expired", "months_until_expiry")
    # cards join accounts first: customers without account would all meet on NULL
    joined = holder.join(held.join(issued, "account_id", "left"), "customer_id", "left")
    status = ladder([(F.col("is_expired"), "Expired"), (F.col("months_until_expiry") <= 3, "Expiring Soon")], "Active")
    category = ladder([(F.col("card_type") == "Credit", "Credit Card"), (F.col("card_type") == "Debit", "Debit Card")], "Other")
    return joined.select(
        *holder.columns,
        "account_id",
        "account_type",
        "balance_usd",
        "card_id",
        "card_type",
        "expiration_date",
        "is_expired",
        "months_until_expiry",
        status.alias("card_status"),
        date_diff("expiration_date", moment(as_of), "day").alias("days_since_expiry"),
        category.alias("card_category"),
    )


def dim_customers(c360: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The customer dimension: customer 360 plus segments."""
    quintile, balance, rating = F.col("wealth_quintile"), F.col("total_balance_usd"), F.col("credit_rating")
    wealth = ladder([(quintile == q, label) for q, label in WEALTH_LABELS.items()], "Bottom 20%")
    trusted = rating.isin("Excellent", "Good")
    segment = ladder(
        [
            ((balance > 100000) & trusted, "Premium"),
            ((balance > 50000) & trusted, "High Value"),
            ((balance > 20000) & (F.col("total_accounts") > 1), "Standard"),
        ],
        "Basic",
    )
    growth = ladder(
        [
            ((rating == "Excellent") & (F.col("customer_age_years") < 3), "High Growth"),
            ((rating == "Good") & (F.col("total_loans") == 0), "Upsell Opportunity"),
            (rating.isin("Fair", "Poor") & (F.col("total_loans") > 0), "Risk"),
        ],
        "Stable",
    )
    kept = [
        "customer_sk", "customer_id", "customer_business_key", "first_name", "last_name", "email_masked", "customer_city",
        "credit_score", "credit_rating", "customer_tier", "customer_age_years", "created_at",
        "total_accounts", "total_balance_usd", "avg_account_balance", "account_types",
        "total_loans", "total_loan_amount", "avg_interest_rate",
        "total_cards", "credit_cards", "debit_cards", "expired_cards", "cards_expiring_soon",
        "net_worth", "debt_to_asset_ratio", "financial_health_status",
    ]
    return c360.select(
        *kept,
        wealth.alias("wealth_segment"),
        segment.alias("customer_segment"),
        growth.alias("growth_potential"),
        hash_column("customer_id").alias("customer_id_hash"),
        moment(as_of).alias("dbt_updated_at"),
    )
