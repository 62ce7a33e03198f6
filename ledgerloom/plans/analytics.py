"""Lifetime value, segments and spending patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.casts import AsOf, date_diff, moment
from ..functions.expressions import banded, ladder
from ..functions.windows import rolling_mean, share_percent
from ..operators.ordered import row_counts
from ..operators.percentiles import exact_percentiles

# Margin, and lower ends (exclusive) of the value tiers.
MARGIN = "0.3"
CLV_TIERS = [(50000, "High Value"), (20000, "Medium Value"), (5000, "Low Value")]


def spend_per_customer(facts: DataFrame) -> DataFrame:
    amount, when = F.col("amount_usd"), F.col("transaction_date")
    spent = facts.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum(amount).alias("total_spend"),
        F.avg(amount).alias("avg_transaction_value"),
        F.min(when).alias("first_transaction"),
        F.max(when).alias("last_transaction"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
    )
    return spent.withColumn("customer_lifetime_days", date_diff("first_transaction", "last_transaction", "day"))


def lifetime_value(facts: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Spend, yearly value and lifetime value per customer, or of one customer."""
    rows = facts if customer_id is None else facts.filter(F.col("customer_id") == customer_id)
    spent = spend_per_customer(rows)
    days = F.nullif("customer_lifetime_days", F.lit(0).cast("bigint"))
    return spent.select(
        *([] if customer_id is not None else ["customer_id"]),
        "total_spend",
        F.col("total_transactions").alias("transaction_count"),
        "customer_lifetime_days",
        (F.try_divide("total_spend", days) * 365).alias("annual_value"),
        (F.col("total_spend") * F.lit(MARGIN).cast("decimal(1,1)")).alias("estimated_lifetime_value"),
    )


def clv_analysis(facts: DataFrame, customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row per customer with transactions, from the fact table."""
    spent = spend_per_customer(facts)
    value = F.round(F.col("total_spend") * F.lit(MARGIN).cast("decimal(1,1)"), 2)
    days = F.nullif("customer_lifetime_days", F.lit(0).cast("bigint")).cast("int")
    count, shops = F.col("total_transactions"), F.col("unique_merchants")
    engagement = ladder(
        [((count > 100) & (shops > 20), 10), ((count > 50) & (shops > 10), 7), ((count > 20) & (shops > 5), 4)], 1
    )
    scored = spent.withColumns(
        {
            "estimated_clv": value,
            "annualized_value": F.round(F.try_divide("total_spend", days) * 365, 2),
            "engagement_score": engagement,
        }
    ).withColumn("clv_tier", banded("estimated_clv", CLV_TIERS, "Lowest Value", strict=True))
    score, tier = F.col("engagement_score"), F.col("clv_tier")
    strategy = ladder(
        [
            ((score >= 7) & tier.isin("Low Value", "Lowest Value"), "High Growth Potential"),
            ((score >= 4) & (tier == "Medium Value"), "Upsell Opportunity"),
            ((score >= 7) & (tier == "High Value"), "Premium Retention"),
        ],
        "Monitor",
    )
    people = customers.select("customer_id", "first_name", "last_name", "credit_score", "credit_rating", "customer_tier")
    return scored.join(people, "customer_id", "left").select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "credit_score",
        "credit_rating",
        "customer_tier",
        "total_transactions",
        "total_spend",
        "avg_transaction_value",
        "customer_lifetime_days",
        "unique_merchants",
        "estimated_clv",
        "annualized_value",
        "clv_tier",
        "engagement_score",
        strategy.alias("growth_strategy"),
        moment(as_of).alias("analysis_date"),
        moment(as_of).alias("dbt_updated_at"),
    )


def segment_analysis(dim: DataFrame, customers: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """One row per customer segment, from the customer dimension.

    ``customers``, the table below the dimension, is only counted.
    """
    needed = ["customer_id", "customer_segment", "total_balance_usd", "net_worth", "credit_score", "financial_health_status"]
    known = dim.filter(F.col("customer_segment").isNotNull()).select(*needed)
    health = F.col("financial_health_status")
    sums = exact_percentiles(
        known,
        ["customer_segment"],
        {"median_balance": ("total_balance_usd", 0.5), "median_net_worth": ("net_worth", 0.5)},
        aggregates={
            "customer_count": F.count("customer_id"),
            "total_portfolio_value": F.sum("total_balance_usd"),
            "avg_balance": F.avg("total_balance_usd"),
            "total_net_worth": F.sum("net_worth"),
            "avg_credit_score": F.avg("credit_score"),
            "healthy_customers": F.count_if(health == "Excellent"),
            "at_risk_customers": F.count_if(health == "Needs Attention"),
        },
        at_most=customers,
        hot_rows=hot_rows,
        store=True,
    )
    # at most one row per segment label from here on
    everything = F.sum("total_portfolio_value").over(Window.partitionBy())
    part = lambda name: F.round(F.try_divide(F.col(name), F.col("customer_count")) * 100, 2)
    return (
        sums.select(
            "customer_segment",
            "customer_count",
            "total_portfolio_value",
            "avg_balance",
            "total_net_worth",
            "avg_credit_score",
            "median_balance",
            "median_net_worth",
            "healthy_customers",
            "at_risk_customers",
            part("healthy_customers").alias("health_percentage"),
            part("at_risk_customers").alias("risk_percentage"),
            F.round(share_percent(F.col("total_portfolio_value"), everything), 2).alias("portfolio_concentration"),
        )
        .orderBy(F.desc("total_portfolio_value"))
    )


PERIOD = ["transaction_year", "transaction_month", "transaction_dayofweek", "time_of_day", "day_type", "is_holiday"]


def transaction_patterns(
    facts: DataFrame, transactions: DataFrame | None = None, size: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Totals, anomaly rate and trend per calendar slot, from the fact table.

    ``transactions``, the staged table below the facts, is counted per slot in
    their place; ``size`` is a bound on the number of rows, if known.
    """
    amount, flag = F.col("amount_usd"), F.col("transaction_risk_flag")
    slots = exact_percentiles(
        facts.select(*PERIOD, "transaction_id", "amount_usd", "transaction_risk_flag"),
        PERIOD,
        {"median_amount": ("amount_usd", 0.5), "p95_amount": ("amount_usd", 0.95)},
        aggregates={
            "transaction_count": F.count("transaction_id"),
            "total_amount": F.sum(amount),
            "avg_amount": F.avg(amount),
            "anomaly_count": F.count_if(flag == "Anomaly"),
            "suspicious_count": F.count_if(flag == "Suspicious"),
        },
        counts=None if transactions is None else row_counts(transactions, PERIOD),
        at_most=size,
        hot_rows=hot_rows,
        store=True,
    )
    # the calendar bounds the number of slots, so one ordered window holds them;
    # the further group columns make the order total
    timeline = Window.partitionBy(F.lit(1)).orderBy(*PERIOD)
    total, anomalies, count = F.col("total_amount"), F.col("anomaly_count"), F.col("transaction_count")
    rolled = slots.withColumns(
        {
            "rolling_3month_avg": rolling_mean("total_amount", timeline, 3),
            "rolling_3month_volume": rolling_mean("transaction_count", timeline, 3),
        }
    )
    mean = F.col("rolling_3month_avg")
    return rolled.select(
        *PERIOD,
        "transaction_count",
        "total_amount",
        "avg_amount",
        "median_amount",
        "p95_amount",
        "anomaly_count",
        "suspicious_count",
        F.round(F.try_divide(anomalies, count) * 100, 2).alias("anomaly_rate"),
        "rolling_3month_avg",
        "rolling_3month_volume",
        ladder([(total > mean, "Increasing"), (total < mean, "Decreasing")], "Stable").alias("trend_direction"),
        ladder(
            [((anomalies > 5) & (count > 100), "High Risk Period"), ((anomalies > 2) & (count > 50), "Elevated Risk")],
            "Normal Operations",
        ).alias("risk_period_category"),
    ).orderBy(F.desc("transaction_year"), F.desc("transaction_month"))
