"""Typed, cleaned forms of the source tables, one projection each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import AsOf, add_years, age_years, date_diff, moment, safe_decimal, safe_timestamp
from ..functions.expressions import banded, hash_column, ladder, mask_pii
from ..operators.projection import nullcheck

# Lower ends of the bands, highest first.
CREDIT_RATINGS = [(800, "Excellent"), (740, "Good"), (670, "Fair"), (580, "Poor")]
INTEREST_BANDS = [(10, "High Interest"), (7, "Medium Interest")]
SIZE_BANDS = [(10000, "High Value"), (1000, "Medium Value"), (100, "Low Value")]
LOAN_YEARS = 5
PAYMENTS = 60


def stg_accounts(accounts: DataFrame) -> DataFrame:
    opened = safe_timestamp("open_date")
    return accounts.select(
        "account_id",
        "customer_id",
        "account_type",
        safe_decimal("balance_usd").alias("balance_usd"),
        opened.alias("open_date"),
        F.to_date(opened).alias("open_date_only"),
        F.year(opened).alias("open_year"),
        F.month(opened).alias("open_month"),
        F.quarter(opened).alias("open_quarter"),
    )


def stg_branches(branches: DataFrame) -> DataFrame:
    kept = branches.select("branch_id", "branch_name", "manager_name", "city", "country")
    return nullcheck(kept, ["city", "country"])


def stg_cards(cards: DataFrame, as_of: AsOf = None) -> DataFrame:
    now, expires = moment(as_of), safe_timestamp("expiration_date")
    return cards.select(
        "card_id",
        "account_id",
        "card_type",
        expires.alias("expiration_date"),
        F.to_date(expires).alias("expiration_date_only"),
        F.coalesce(expires < now, F.lit(False)).alias("is_expired"),
        date_diff(now, expires, "month").alias("months_until_expiry"),
        F.year(expires).alias("expiry_year"),
        F.month(expires).alias("expiry_month"),
    )


def stg_customers(customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    score, created = safe_decimal("credit_score", 3, 0), safe_timestamp("created_at")
    tenure = age_years(created, as_of)
    tier = ladder(
        [
            ((tenure > 5) & (score >= 740), "Platinum"),
            ((tenure > 3) & (score >= 670), "Gold"),
            (tenure > 1, "Silver"),
        ],
        "Bronze",
    )
    return customers.select(
        "customer_id",
        "first_name",
        "last_name",
        mask_pii("email").alias("email_masked"),
        hash_column("email").alias("email_hash"),
        F.col("email").alias("email_raw"),
        "city",
        score.alias("credit_score"),
        created.alias("created_at"),
        F.to_date(created).alias("created_date_only"),
        F.year(created).alias("created_year"),
        F.month(created).alias("created_month"),
        tenure.alias("customer_age_years"),
        banded(score, CREDIT_RATINGS, "Bad").alias("credit_rating"),
        tier.alias("customer_tier"),
    )


def stg_loans(loans: DataFrame, as_of: AsOf = None, periods_per_year: int = 1) -> DataFrame:
    """Loans of five years in 60 payments.

    The payment formula takes the annual rate per payment by default;
    ``periods_per_year=12`` spreads it over the months.
    """
    now = moment(as_of)
    typed = loans.select(
        "loan_id",
        "customer_id",
        safe_decimal("loan_amount").alias("loan_amount"),
        safe_decimal("interest_rate", 5, 2).alias("interest_rate"),
        safe_timestamp("start_date").alias("start_date"),
    ).withColumn("maturity_date", add_years("start_date", LOAN_YEARS))

    principal, rate = F.col("loan_amount"), F.col("interest_rate")
    per_period = rate.cast("double") / (100 * periods_per_year)
    growth = F.pow(1 + per_period, F.lit(PAYMENTS))
    annuity = F.round(principal.cast("double") * per_period * growth / (growth - 1), 2)
    payment = F.when(rate > 0, annuity).otherwise(principal.cast("double") / PAYMENTS)
    elapsed = date_diff("start_date", now, "year")
    status = ladder(
        [
            (F.col("maturity_date") < now, "Completed"),
            (elapsed >= 4, "Near Maturity"),
            (elapsed >= 3, "Mid-Term"),
            (elapsed >= 1, "Active"),
        ],
        "Recent",
    )
    paid = typed.withColumn("estimated_monthly_payment", payment)
    interest = safe_decimal("estimated_monthly_payment") * PAYMENTS - principal
    return paid.select(
        "loan_id",
        "customer_id",
        "loan_amount",
        "interest_rate",
        "start_date",
        F.to_date("start_date").alias("start_date_only"),
        F.year("start_date").alias("start_year"),
        F.month("start_date").alias("start_month"),
        "maturity_date",
        date_diff("start_date", now, "month").alias("loan_age_months"),
        status.alias("loan_status"),
        "estimated_monthly_payment",
        F.round(interest, 2).alias("total_interest_estimate"),
        banded(rate, INTEREST_BANDS, "Low Interest").alias("interest_category"),
        principal.alias("loan_amount_display"),
    )


def stg_merchants(merchants: DataFrame) -> DataFrame:
    return merchants.select("merchant_id", "merchant_name", "city")


def stg_transactions(transactions: DataFrame, weekend_days: Sequence[int] = (6, 7)) -> DataFrame:
    """``weekend_days`` counts from Sunday = 1; the default is Friday and Saturday."""
    typed = transactions.select(
        "transaction_id",
        "account_id",
        "merchant_id",
        safe_decimal("amount_usd").alias("amount_usd"),
        safe_timestamp("transaction_date").alias("transaction_date"),
    )
    when = F.col("transaction_date")
    hour, weekday = F.hour(when), F.dayofweek(when)
    month, day = F.month(when), F.dayofmonth(when)
    time_of_day = ladder(
        [(hour.between(6, 11), "Morning"), (hour.between(12, 17), "Afternoon"), (hour.between(18, 23), "Evening")], "Night"
    )
    holiday = ((month == 12) & (day == 25)) | ((month == 1) & (day == 1))
    return typed.select(
        "*",
        F.to_date(when).alias("transaction_date_only"),
        F.date_format(when, "HH:mm:ss").alias("transaction_time"),
        F.year(when).alias("transaction_year"),
        month.alias("transaction_month"),
        F.quarter(when).alias("transaction_quarter"),
        day.alias("transaction_day"),
        hour.alias("transaction_hour"),
        weekday.alias("transaction_dayofweek"),
        time_of_day.alias("time_of_day"),
        banded("amount_usd", SIZE_BANDS, "Micro").alias("transaction_size"),
        F.when(weekday.isin(*weekend_days), "Weekend").otherwise("Weekday").alias("day_type"),
        F.coalesce(holiday, F.lit(False)).alias("is_holiday"),
    )
