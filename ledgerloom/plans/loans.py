"""Loan portfolio risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.casts import AsOf, age_years, date_diff, moment, safe_decimal
from ..functions.expressions import ladder, surrogate_key
from ..functions.windows import share_percent
from ..operators.percentiles import exact_percentiles


def loan_portfolio(loans: DataFrame, customers: DataFrame, as_of: AsOf = None, hot_rows: int | None = None) -> DataFrame:
    """One row per loan, from the staged tables."""
    now = moment(as_of)
    borrower = customers.select("customer_id", "first_name", "last_name", "credit_score", "credit_rating", "customer_tier")
    # one row of statistics in place of windows over the whole table
    marks = exact_percentiles(
        loans,
        [],
        {"interest_rate_75th_percentile": ("interest_rate", 0.75), "loan_amount_90th_percentile": ("loan_amount", 0.9)},
        aggregates={"_total": F.sum("loan_amount")},
        hot_rows=hot_rows,
    )
    joined = loans.join(borrower, "customer_id", "left").crossJoin(F.broadcast(marks))
    rate, score, left = F.col("interest_rate"), F.col("credit_score"), date_diff(now, "maturity_date", "month")
    risk = ladder([((rate > 10) & (score < 670), "High Risk"), ((rate > 7) & (score < 700), "Medium Risk")], "Low Risk")
    maturity = ladder([(F.col("maturity_date") < now, "Matured"), (left <= 6, "Near Maturity")], "Active")
    amount = F.col("loan_amount")
    return joined.select(
        "loan_id",
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "credit_score",
        "credit_rating",
        "customer_tier",
        "loan_amount",
        "interest_rate",
        "start_date",
        "maturity_date",
        "loan_status",
        "estimated_monthly_payment",
        "total_interest_estimate",
        "interest_category",
        "loan_age_months",
        risk.alias("risk_category"),
        "interest_rate_75th_percentile",
        "loan_amount_90th_percentile",
        share_percent(safe_decimal("loan_amount"), F.nullif("_total", F.lit(0))).alias("loan_percentage_of_portfolio"),
        F.round(amount * (rate / 100), 2).alias("projected_annual_interest_income"),
        age_years("start_date", as_of).alias("loan_age_years"),
        left.alias("months_to_maturity"),
        maturity.alias("maturity_status"),
        surrogate_key(["loan_id", "start_date"]).alias("loan_sk"),
    )


GROUP = ["loan_status", "risk_category", "interest_category", "maturity_status"]

# Weights of the loan amount in risk-weighted assets.
RISK_WEIGHTS = {"High Risk": 1.5, "Medium Risk": 1.0}
OTHER_WEIGHT = 0.5


def loan_portfolio_analysis(
    portfolio: DataFrame, as_of: AsOf = None, loans: DataFrame | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Portfolio totals by status, risk, interest band and maturity.

    ``loans``, the table below the portfolio, is only counted: a small one
    rules out large groups without evaluating the portfolio for it.
    """
    amount, risk = F.col("loan_amount"), F.col("risk_category")
    weight = F
    for label, factor in RISK_WEIGHTS.items():
        weight = weight.when(risk == label, amount * F.lit(factor).cast("decimal(2,1)"))
    weighted = weight.otherwise(amount * F.lit(OTHER_WEIGHT).cast("decimal(2,1)"))
    needed = [*GROUP, "loan_id", "loan_amount", "interest_rate", "projected_annual_interest_income", "credit_score"]
    sums = exact_percentiles(
        portfolio.select(*needed),
        GROUP,
        {"median_interest_rate": ("interest_rate", 0.5), "p90_loan_amount": ("loan_amount", 0.9)},
        aggregates={
            "loan_count": F.count("loan_id"),
            "total_loan_value": F.sum(amount),
            "avg_interest_rate": F.avg("interest_rate"),
            "total_annual_interest_income": F.sum("projected_annual_interest_income"),
            "avg_borrower_credit_score": F.avg("credit_score"),
            "risk_weighted_assets": F.sum(weighted),
        },
        at_most=loans,
        hot_rows=hot_rows,
        store=True,
    )
    value = F.col("total_loan_value")
    # the labels bound the number of groups, so windows over them stay small;
    # a category's share is taken over all its groups
    by_risk = F.sum(value).over(Window.partitionBy("risk_category"))
    whole = F.sum(value).over(Window.partitionBy())
    concentration = F.round(share_percent(by_risk, F.nullif(whole, F.lit(0))), 2)
    health = ladder(
        [
            ((risk == "High Risk") & (value > 1000000), "Critical Exposure"),
            (risk == "High Risk", "High Exposure"),
            ((risk == "Medium Risk") & (value > 2000000), "Moderate Exposure"),
        ],
        "Healthy Portfolio",
    )
    return (
        sums.withColumn("portfolio_concentration_percentage", concentration)
        .select(
            *GROUP,
            "loan_count",
            "total_loan_value",
            "avg_interest_rate",
            "median_interest_rate",
            "p90_loan_amount",
            "total_annual_interest_income",
            "avg_borrower_credit_score",
            "risk_weighted_assets",
            "portfolio_concentration_percentage",
            health.alias("portfolio_health_status"),
            F.round(F.try_divide("total_annual_interest_income", F.nullif(value, F.lit(0))) * 100, 2).alias("yield_on_portfolio"),
            F.round((100 - F.col("avg_borrower_credit_score")) / 100, 2).alias("estimated_default_risk"),
            moment(as_of).alias("analysis_timestamp"),
        )
        .orderBy(F.desc("total_loan_value"))
    )
