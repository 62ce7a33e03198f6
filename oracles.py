"""DuckDB SQL with the results of the registered queries.

Money is kept in whole cents and divided at the end, so decimal rounding is
exact. ``assemble`` puts the shared subqueries a statement names in front of it.
"""

from __future__ import annotations

import re

NOW = "TIMESTAMP '2002-01-01 00:00:00'"
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def rdiv(num: str, den: str, digits: int) -> str:
    """num / den in units of 10^-digits, rounded half away from zero, as an integer."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CASE WHEN ({num} < 0) <> ({den} < 0) THEN -1 ELSE 1 END * ((2 * abs({n}) * {10**digits} + abs({d})) // nullif(2 * abs({d}), 0)))"


def ratio(num: str, den: str, digits: int) -> str:
    return f"({rdiv(num, den, digits)}::DOUBLE / {10**digits})"


def avg6(cents: str, n: str) -> str:
    """Average of cents in units, with six digits."""
    return f"({rdiv(cents, n, 4)}::DOUBLE / 1000000)"


def month_diff(x: str, y: str) -> str:
    """Whole months between two midnights."""
    packed = lambda d: f"((year({d}) * 12 + month({d})) * 32 + day({d}))"
    return f"CAST(trunc(({packed(y)} - {packed(x)}) / 32) AS BIGINT)"


def age(x: str) -> str:
    return f"CAST(floor(datediff('day', CAST({x} AS DATE), DATE '2002-01-01') / 365.25) AS BIGINT)"


def sk(*cols: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in cols) + "))"


def money_text(c: str) -> str:
    return f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || CAST(abs({c}) // 100 AS VARCHAR) || '.' || lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0'))"


SUBQUERIES = {
    "s_customers": f"""
        SELECT *, CAST(floor(datediff('day', CAST(created_at AS DATE), DATE '2002-01-01') / 365.25) AS BIGINT) AS customer_age_years,
          left(email, 3) || '********' || right(email, 4) AS email_masked,
          CASE WHEN credit_score >= 800 THEN 'Excellent' WHEN credit_score >= 740 THEN 'Good'
               WHEN credit_score >= 670 THEN 'Fair' WHEN credit_score >= 580 THEN 'Poor' ELSE 'Bad' END AS credit_rating,
          CASE WHEN {age('created_at')} > 5 AND credit_score >= 740 THEN 'Platinum'
               WHEN {age('created_at')} > 3 AND credit_score >= 670 THEN 'Gold'
               WHEN {age('created_at')} > 1 THEN 'Silver' ELSE 'Bronze' END AS customer_tier
        FROM (SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
                lower(c_name) || '@bank.example' AS email, n_name AS city,
                CAST(300 + (c_custkey * 37) % 551 AS BIGINT) AS credit_score,
                CAST(DATE '1990-01-01' + CAST((c_custkey * 7) % 4000 AS INTEGER) AS TIMESTAMP) AS created_at
              FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""",
    "s_accounts": """
        SELECT c_custkey AS account_id, c_custkey - c_custkey % 2 AS customer_id, c_mktsegment AS account_type,
          CAST(round(c_acctbal * 1500) AS BIGINT) AS bal,
          CAST(DATE '1991-01-01' + CAST((c_custkey * 13) % 3900 AS INTEGER) AS TIMESTAMP) AS open_date
        FROM customer""",
    "s_cards": f"""
        SELECT *, expiration_date < {NOW} AS is_expired, {month_diff(NOW, 'expiration_date')} AS months_until_expiry
        FROM (SELECT c_custkey + 1000000 AS card_id, c_custkey AS account_id,
                CASE c_custkey % 3 WHEN 0 THEN 'Credit' WHEN 1 THEN 'Debit' ELSE 'Prepaid' END AS card_type,
                CAST(DATE '2001-01-01' + CAST((c_custkey * 17) % 1100 AS INTEGER) AS TIMESTAMP) AS expiration_date
              FROM customer)""",
    "s_loans": f"""
        SELECT *, CASE WHEN maturity_date < {NOW} THEN 'Completed'
            WHEN date_sub('year', start_date, {NOW}) >= 4 THEN 'Near Maturity'
            WHEN date_sub('year', start_date, {NOW}) >= 3 THEN 'Mid-Term'
            WHEN date_sub('year', start_date, {NOW}) >= 1 THEN 'Active' ELSE 'Recent' END AS loan_status,
          CASE WHEN rate >= 10 THEN 'High Interest' WHEN rate >= 7 THEN 'Medium Interest' ELSE 'Low Interest' END AS interest_category,
          {month_diff('start_date', NOW)} AS loan_age_months,
          round(CAST(round(payment * 100) AS BIGINT) * 60 / 100.0 - amt / 100.0, 2) AS total_interest_estimate
        FROM (SELECT *, start_date + INTERVAL 5 YEAR AS maturity_date,
                CASE WHEN rate > 0 THEN round(amt / 100.0::DOUBLE * (rate / 100.0::DOUBLE) * pow(1 + rate / 100.0::DOUBLE, 60)
                       / (pow(1 + rate / 100.0::DOUBLE, 60) - 1), 2)
                     ELSE amt / 100.0::DOUBLE / 60 END AS payment
              FROM (SELECT p_partkey AS loan_id, p_partkey AS customer_id, CAST(round(p_retailprice * 10000) AS BIGINT) AS amt,
                      CAST(p_size % 15 AS BIGINT) AS rate,
                      CAST(DATE '1993-01-01' + CAST((p_partkey * 11) % 3200 AS INTEGER) AS TIMESTAMP) AS start_date
                    FROM part))""",
    "s_merchants": """
        SELECT s_suppkey AS merchant_id, s_name AS merchant_name, n_name AS city
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_txn": """
        SELECT o_orderkey AS transaction_id, o_custkey AS account_id, merchant_id,
          CAST(round(o_totalprice * 4) AS BIGINT) AS amt, o_orderdate AS transaction_date
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS merchant_id FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "raw_events": """
        SELECT event_id AS transaction_id, user_id AS account_id, event_id % 7 AS merchant_id,
          CAST(round(value * 100) AS BIGINT) AS amt, ts AS transaction_date FROM events""",
}


def parts(source: str) -> str:
    d = "transaction_date"
    return f"""
        SELECT *, CAST({d} AS DATE) AS transaction_date_only, strftime({d}, '%H:%M:%S') AS transaction_time,
          year({d}) AS transaction_year, month({d}) AS transaction_month, quarter({d}) AS transaction_quarter,
          day({d}) AS transaction_day, hour({d}) AS transaction_hour, dayofweek({d}) + 1 AS transaction_dayofweek,
          CASE WHEN hour({d}) BETWEEN 6 AND 11 THEN 'Morning' WHEN hour({d}) BETWEEN 12 AND 17 THEN 'Afternoon'
               WHEN hour({d}) BETWEEN 18 AND 23 THEN 'Evening' ELSE 'Night' END AS time_of_day,
          CASE WHEN amt >= 1000000 THEN 'High Value' WHEN amt >= 100000 THEN 'Medium Value'
               WHEN amt >= 10000 THEN 'Low Value' ELSE 'Micro' END AS transaction_size,
          CASE WHEN dayofweek({d}) + 1 IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
          (month({d}) = 12 AND day({d}) = 25) OR (month({d}) = 1 AND day({d}) = 1) AS is_holiday
        FROM {source}"""


def measures(source: str) -> str:
    back = lambda n: f"(PARTITION BY customer_id ORDER BY transaction_date, transaction_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    rolling = lambda n: avg6(f"sum(amt) OVER {back(n)}", f"count(*) OVER {back(n)}")
    mean = avg6("sum(amt) OVER (PARTITION BY customer_id)", "count(*) OVER (PARTITION BY customer_id)")
    return f"""
        SELECT *, CASE WHEN abs(z) > 3 THEN 'Anomaly' WHEN abs(z) > 2 THEN 'Suspicious' ELSE 'Normal' END AS transaction_risk_flag
        FROM (SELECT *, {rolling(7)} AS rolling_7day_avg, {rolling(30)} AS rolling_30day_avg,
                sum(amt) OVER {back('UNBOUNDED')} AS running,
                date_sub('hour', lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date, transaction_id), transaction_date) AS gap,
                (amt / 100.0::DOUBLE - {mean}) / nullif(stddev_samp(amt / 100.0::DOUBLE) OVER (PARTITION BY customer_id), 0) AS z
              FROM {source})"""


SUBQUERIES.update(
    {
        "s_txn": parts("raw_txn"),
        "s_events": parts("raw_events"),
        "totals": f"""
        SELECT customer_id, count(*) AS n, sum(bal) AS bal, {avg6('sum(bal)', 'count(*)')} AS avg_bal,
          string_agg(DISTINCT account_type, ', ' ORDER BY account_type) AS account_types
        FROM s_accounts GROUP BY 1""",
        "scores": """
        SELECT customer_id, rank() OVER (ORDER BY bal DESC) AS balance_rank, ntile(5) OVER (ORDER BY bal DESC, customer_id) AS wealth_quintile
        FROM totals""",
        "open_loans": f"""
        SELECT customer_id, count(*) AS n, sum(amt) AS amt, {avg6('sum(rate) * 100', 'count(*)')} AS avg_rate
        FROM s_loans WHERE loan_status <> 'Completed' GROUP BY 1""",
        "card_counts": """
        SELECT customer_id, count(*) AS total_cards, count(*) FILTER (card_type = 'Credit') AS credit_cards,
          count(*) FILTER (card_type = 'Debit') AS debit_cards, count(*) FILTER (is_expired) AS expired_cards,
          count(*) FILTER (months_until_expiry <= 3 AND NOT is_expired) AS cards_expiring_soon
        FROM s_cards LEFT JOIN s_accounts USING (account_id) GROUP BY 1""",
        "c360": f"""
        SELECT c.customer_id, c.first_name, c.last_name, c.email_masked, c.city AS customer_city, c.credit_score::DOUBLE AS credit_score,
          c.credit_rating, c.customer_tier, c.customer_age_years, c.created_at,
          coalesce(a.n, 0) AS total_accounts, coalesce(a.bal, 0) AS bal, coalesce(a.avg_bal, 0) AS avg_account_balance, a.account_types,
          coalesce(l.n, 0) AS total_loans, coalesce(l.amt, 0) AS debt, coalesce(l.avg_rate, 0) AS avg_interest_rate,
          coalesce(d.total_cards, 0) AS total_cards, coalesce(d.credit_cards, 0) AS credit_cards, coalesce(d.debit_cards, 0) AS debit_cards,
          coalesce(d.expired_cards, 0) AS expired_cards, coalesce(d.cards_expiring_soon, 0) AS cards_expiring_soon,
          {ratio('coalesce(a.bal, 0)', 'coalesce(l.amt, 0)', 2)} AS debt_to_asset_ratio,
          CASE WHEN s.customer_id IS NOT NULL THEN (SELECT quantile_cont(bal / 100.0::DOUBLE, 0.9) FROM totals) END AS p90,
          s.balance_rank, s.wealth_quintile, {sk('c.customer_id', 'c.created_at')} AS customer_sk,
          c.first_name || '~' || c.last_name || '~' || c.email_masked AS customer_business_key,
          CASE WHEN coalesce(a.bal, 0) * 2 > coalesce(l.amt, 0) * 3 THEN 'Excellent' WHEN coalesce(a.bal, 0) > coalesce(l.amt, 0) THEN 'Good'
               WHEN coalesce(a.bal, 0) * 2 > coalesce(l.amt, 0) THEN 'Fair' ELSE 'Needs Attention' END AS financial_health_status
        FROM s_customers c LEFT JOIN totals a ON c.customer_id = a.customer_id LEFT JOIN open_loans l ON c.customer_id = l.customer_id
          LEFT JOIN card_counts d ON c.customer_id = d.customer_id LEFT JOIN scores s ON c.customer_id = s.customer_id""",
        "dim": """
        SELECT *, CASE wealth_quintile WHEN 1 THEN 'Top 20%' WHEN 2 THEN 'Upper Middle 20%' WHEN 3 THEN 'Middle 20%'
               WHEN 4 THEN 'Lower Middle 20%' ELSE 'Bottom 20%' END AS wealth_segment,
          CASE WHEN bal > 10000000 AND credit_rating IN ('Excellent', 'Good') THEN 'Premium'
               WHEN bal > 5000000 AND credit_rating IN ('Excellent', 'Good') THEN 'High Value'
               WHEN bal > 2000000 AND total_accounts > 1 THEN 'Standard' ELSE 'Basic' END AS customer_segment,
          CASE WHEN credit_rating = 'Excellent' AND customer_age_years < 3 THEN 'High Growth'
               WHEN credit_rating = 'Good' AND total_loans = 0 THEN 'Upsell Opportunity'
               WHEN credit_rating IN ('Fair', 'Poor') AND total_loans > 0 THEN 'Risk' ELSE 'Stable' END AS growth_potential
        FROM c360""",
        "portfolio": f"""
        SELECT l.*, c.first_name || ' ' || c.last_name AS customer_name, c.credit_score, c.credit_rating, c.customer_tier,
          CASE WHEN rate > 10 AND credit_score < 670 THEN 'High Risk' WHEN rate > 7 AND credit_score < 700 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category,
          amt * rate // 100 AS income, {month_diff(NOW, 'maturity_date')} AS months_to_maturity,
          CASE WHEN maturity_date < {NOW} THEN 'Matured' WHEN {month_diff(NOW, 'maturity_date')} <= 6 THEN 'Near Maturity' ELSE 'Active' END AS maturity_status
        FROM s_loans l LEFT JOIN s_customers c USING (customer_id)""",
        "owned_txn": "SELECT t.*, a.customer_id, a.account_type, a.bal FROM s_txn t LEFT JOIN s_accounts a USING (account_id)",
        "owned_events": "SELECT *, account_id AS customer_id FROM s_events",
        "measured": measures("owned_txn"),
        "measured_events": measures("owned_events"),
        "marks": """
        SELECT quantile_cont(amt / 100.0::DOUBLE, 0.95) AS p95, quantile_cont(amt / 100.0::DOUBLE, 0.99) AS p99,
          quantile_cont(amt / 100.0::DOUBLE, 0.75) AS p75 FROM s_txn""",
        "enriched": f"""
        SELECT {sk('t.transaction_id', 't.customer_id')} AS transaction_sk, t.*, m.merchant_name, m.city AS merchant_city,
          c.first_name || ' ' || c.last_name AS customer_name, c.credit_score::DOUBLE AS credit_score, c.credit_rating, c.customer_tier,
          CASE WHEN amt / 100.0::DOUBLE > p95 THEN 'High Value' WHEN amt / 100.0::DOUBLE > p75 THEN 'Above Average' ELSE 'Normal' END AS value_category,
          p95, p99, p75
        FROM measured t LEFT JOIN s_customers c USING (customer_id) LEFT JOIN s_merchants m USING (merchant_id) CROSS JOIN marks""",
        "spend": f"""
        SELECT customer_id, count(*) AS n, sum(amt) AS amt, {avg6('sum(amt)', 'count(*)')} AS avg_spend,
          quantile_cont(amt / 100.0::DOUBLE, 0.5) AS p50, quantile_cont(amt / 100.0::DOUBLE, 0.75) AS c75, quantile_cont(amt / 100.0::DOUBLE, 0.9) AS c90,
          count(*) FILTER (amt > 1000000) AS high, min(transaction_date) AS first_t, max(transaction_date) AS last_t,
          count(DISTINCT merchant_id) AS shops, date_sub('day', min(transaction_date), max(transaction_date)) AS days
        FROM owned_txn GROUP BY 1""",
        "metrics": f"""
        SELECT account_id, count(*) AS n, sum(amt) AS amt, {avg6('sum(amt)', 'count(*)')} AS avg_t, quantile_cont(amt / 100.0::DOUBLE, 0.5) AS p50,
          min(amt) AS lo, max(amt) AS hi, min(transaction_date) AS first_t, max(transaction_date) AS last_t,
          count(DISTINCT merchant_id) AS shops, count(*) FILTER (amt > 1000000) AS high,
          count(*)::DOUBLE / nullif({month_diff('min(transaction_date)', 'max(transaction_date)')}, 0) AS per_month
        FROM s_txn GROUP BY 1""",
        "summary": f"""
        SELECT a.*, c.first_name || ' ' || c.last_name AS customer_name, c.credit_score::DOUBLE AS credit_score, c.credit_rating, c.customer_tier,
          {age('open_date')} AS account_age_years, m.n, m.amt, m.avg_t, m.p50, m.lo, m.hi, m.first_t, m.last_t, m.shops, m.high, m.per_month,
          CASE WHEN coalesce(m.n, 0) > 50 THEN 'Very Active' WHEN coalesce(m.n, 0) > 20 THEN 'Active' WHEN coalesce(m.n, 0) > 5 THEN 'Moderate' ELSE 'Inactive' END AS activity_level,
          CASE WHEN coalesce(m.n, 0) = 0 THEN 'Dormant' WHEN a.bal < 0 THEN 'Overdrawn' WHEN {age('open_date')} > 5 AND m.n > 100 THEN 'Mature Active'
               WHEN {age('open_date')} > 5 THEN 'Mature Low Activity' ELSE 'Standard' END AS account_health_status,
          b.p90 AS balance_90th_percentile, b.p50 AS balance_median,
          CASE WHEN a.bal / 100.0::DOUBLE > b.p90 THEN 'High Balance' WHEN a.bal / 100.0::DOUBLE > b.p50 THEN 'Medium Balance' ELSE 'Low Balance' END AS balance_category
        FROM s_accounts a LEFT JOIN s_customers c USING (customer_id) LEFT JOIN metrics m USING (account_id)
          CROSS JOIN (SELECT quantile_cont(bal / 100.0::DOUBLE, 0.9) AS p90, quantile_cont(bal / 100.0::DOUBLE, 0.5) AS p50 FROM s_accounts) b""",
        "clv": f"""
        SELECT *, CASE WHEN clv_c > 5000000 THEN 'High Value' WHEN clv_c > 2000000 THEN 'Medium Value' WHEN clv_c > 500000 THEN 'Low Value' ELSE 'Lowest Value' END AS clv_tier,
          CASE WHEN n > 100 AND shops > 20 THEN 10 WHEN n > 50 AND shops > 10 THEN 7 WHEN n > 20 AND shops > 5 THEN 4 ELSE 1 END AS engagement_score
        FROM (SELECT *, {rdiv('amt * 3', '10', 0)} AS clv_c FROM spend)""",
        "clv_done": """
        SELECT *, CASE WHEN engagement_score >= 7 AND clv_tier IN ('Low Value', 'Lowest Value') THEN 'High Growth Potential'
               WHEN engagement_score >= 4 AND clv_tier = 'Medium Value' THEN 'Upsell Opportunity'
               WHEN engagement_score >= 7 AND clv_tier = 'High Value' THEN 'Premium Retention' ELSE 'Monitor' END AS growth_strategy
        FROM clv""",
        "lines": "SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem",
        "bare": "SELECT replace(replace(url, 'http://', ''), 'https://', '') AS u, * FROM pages",
        "hosts": """
        SELECT split_part(split_part(replace(u, 'android-app://', ''), '/', 1), '?', 1) AS host,
          split_part(CASE WHEN instr(u, '/') > 0 THEN substr(u, instr(u, '/') + 1) WHEN instr(u, '?') > 0 THEN substr(u, instr(u, '?')) ELSE u END, '?', 1) AS path,
          url FROM bare""",
        "path_n": "SELECT host, path, count(*) AS n_pages FROM hosts GROUP BY 1, 2",
    }
)


def patterns(source: str) -> str:
    period = "transaction_year, transaction_month, transaction_dayofweek, time_of_day, day_type, is_holiday"
    w = f"(ORDER BY {period} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    mean = avg6(f"sum(amt) OVER {w}", f"count(*) OVER {w}")
    return f"""
        SELECT {period}, n AS transaction_count, amt::DOUBLE / 100 AS total_amount, {avg6('amt', 'n')} AS avg_amount,
          round(p50, 4) AS median_amount, round(p95, 4) AS p95_amount, anomaly_count, suspicious_count,
          round(anomaly_count::DOUBLE / n * 100, 2) AS anomaly_rate, {mean} AS rolling_3month_avg,
          round(avg(n) OVER {w}, 4) AS rolling_3month_volume,
          CASE WHEN amt::DOUBLE / 100 > {mean} THEN 'Increasing' WHEN amt::DOUBLE / 100 < {mean} THEN 'Decreasing' ELSE 'Stable' END AS trend_direction,
          CASE WHEN anomaly_count > 5 AND n > 100 THEN 'High Risk Period' WHEN anomaly_count > 2 AND n > 50 THEN 'Elevated Risk' ELSE 'Normal Operations' END AS risk_period_category
        FROM (SELECT {period}, count(*) AS n, sum(amt) AS amt, quantile_cont(amt / 100.0::DOUBLE, 0.5) AS p50, quantile_cont(amt / 100.0::DOUBLE, 0.95) AS p95,
                count(*) FILTER (transaction_risk_flag = 'Anomaly') AS anomaly_count, count(*) FILTER (transaction_risk_flag = 'Suspicious') AS suspicious_count
              FROM {source} GROUP BY ALL)"""


def txn_columns(alias: str = "") -> str:
    return f"""transaction_id, account_id, merchant_id, amt / 100.0::DOUBLE AS amount_usd, {ts('transaction_date')} AS transaction_date,
        {day('transaction_date_only')} AS transaction_date_only, transaction_time, transaction_year, transaction_month, transaction_quarter,
        transaction_day, transaction_hour, transaction_dayofweek, time_of_day, transaction_size, day_type, is_holiday"""


ENRICHED = f"""transaction_sk, transaction_id, account_id, customer_id, account_type, bal / 100.0::DOUBLE AS pre_transaction_balance,
        (bal - amt) / 100.0::DOUBLE AS post_transaction_balance, merchant_id, merchant_name, merchant_city, customer_name, credit_score,
        credit_rating, customer_tier, amt / 100.0::DOUBLE AS amount_usd, {ts('transaction_date')} AS transaction_date, transaction_year,
        transaction_month, transaction_quarter, transaction_dayofweek, transaction_size, time_of_day, day_type, is_holiday,
        rolling_7day_avg, rolling_30day_avg, round(p95, 4) AS transaction_95th_percentile, round(p99, 4) AS transaction_99th_percentile,
        round(z, 4) AS transaction_z_score, transaction_risk_flag, value_category"""

MEASURES = """transaction_id, customer_id, rolling_7day_avg, rolling_30day_avg, running / 100.0::DOUBLE AS cumulative_spend,
        round(z, 4) AS transaction_z_score, transaction_risk_flag, gap AS hours_since_last_transaction"""

CARD_COUNTS = "total_cards, credit_cards, debit_cards, expired_cards, cards_expiring_soon"

UPDATED = f"{ts(NOW)} AS dbt_updated_at"

GRID = "SELECT CAST(generate_series AS TIMESTAMP) AS p FROM generate_series(TIMESTAMP '{0}', TIMESTAMP '{1}', INTERVAL 1 {2})"


def point(key: str) -> str:
    return f"(({key} * 7919) % 17900) / 100.0::DOUBLE - 89.5::DOUBLE AS lat, (({key} * 104729) % 36000) / 100.0::DOUBLE - 180.0::DOUBLE AS lon"


FORMS = "SELECT form, CAST({0} AS BIGINT) AS n_rows, 0::BIGINT AS n_differing FROM (VALUES ('above'), ('middle'), ('one')) AS f(form)"

QUERY_SQL = {
    "stg_accounts": f"""SELECT account_id, customer_id, account_type, bal / 100.0::DOUBLE AS balance_usd, {ts('open_date')} AS open_date,
        {day('open_date')} AS open_date_only, year(open_date) AS open_year, month(open_date) AS open_month, quarter(open_date) AS open_quarter FROM s_accounts""",
    "stg_branches": """SELECT s_suppkey AS branch_id, 'Branch ' || s_name AS branch_name, 'Manager ' || CAST(s_suppkey AS VARCHAR) AS manager_name,
        CASE WHEN s_suppkey % 4 <> 0 THEN n_name END AS city, CASE WHEN s_suppkey % 5 <> 0 THEN r_name END AS country
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "stg_cards": f"""SELECT card_id, account_id, card_type, {ts('expiration_date')} AS expiration_date, {day('expiration_date')} AS expiration_date_only,
        is_expired, months_until_expiry, year(expiration_date) AS expiry_year, month(expiration_date) AS expiry_month FROM s_cards""",
    "stg_customers": f"""SELECT customer_id, first_name, last_name, email_masked, sha256(email) AS email_hash, email AS email_raw, city,
        credit_score::DOUBLE AS credit_score, {ts('created_at')} AS created_at, {day('created_at')} AS created_date_only,
        year(created_at) AS created_year, month(created_at) AS created_month, customer_age_years, credit_rating, customer_tier FROM s_customers""",
    "stg_loans": f"""SELECT loan_id, customer_id, amt / 100.0::DOUBLE AS loan_amount, rate::DOUBLE AS interest_rate, {ts('start_date')} AS start_date,
        {day('start_date')} AS start_date_only, year(start_date) AS start_year, month(start_date) AS start_month, {ts('maturity_date')} AS maturity_date,
        loan_age_months, loan_status, round(payment, 4) AS estimated_monthly_payment, total_interest_estimate::DOUBLE AS total_interest_estimate,
        interest_category, amt / 100.0::DOUBLE AS loan_amount_display FROM s_loans""",
    "stg_merchants": "SELECT merchant_id, merchant_name, city FROM s_merchants",
    "stg_transactions": f"SELECT {txn_columns()} FROM s_txn",
    "stg_event_transactions": f"SELECT {txn_columns()} FROM s_events",
    "customer_360": f"""SELECT customer_id, first_name, last_name, email_masked, customer_city, credit_score, credit_rating, customer_tier, customer_age_years,
        {ts('created_at')} AS created_at, total_accounts, bal / 100.0::DOUBLE AS total_balance_usd, avg_account_balance, account_types, total_loans,
        debt / 100.0::DOUBLE AS total_loan_amount, avg_interest_rate, {CARD_COUNTS}, (bal - debt) / 100.0::DOUBLE AS net_worth, debt_to_asset_ratio,
        round(p90, 4) AS credit_score_90th_percentile, balance_rank, wealth_quintile, customer_sk, customer_business_key, financial_health_status FROM c360""",
    "customer_card_info": f"""SELECT c.customer_id, c.first_name, c.last_name, c.email_masked, c.credit_score::DOUBLE AS credit_score, c.credit_rating,
        a.account_id, a.account_type, a.bal / 100.0::DOUBLE AS balance_usd, d.card_id, d.card_type, {ts('d.expiration_date')} AS expiration_date,
        d.is_expired, d.months_until_expiry, CASE WHEN d.is_expired THEN 'Expired' WHEN d.months_until_expiry <= 3 THEN 'Expiring Soon' ELSE 'Active' END AS card_status,
        date_sub('day', d.expiration_date, {NOW}) AS days_since_expiry,
        CASE d.card_type WHEN 'Credit' THEN 'Credit Card' WHEN 'Debit' THEN 'Debit Card' ELSE 'Other' END AS card_category
        FROM s_customers c LEFT JOIN s_accounts a ON c.customer_id = a.customer_id LEFT JOIN s_cards d ON a.account_id = d.account_id""",
    "dim_customers": f"""SELECT customer_sk, customer_id, customer_business_key, first_name, last_name, email_masked, customer_city, credit_score, credit_rating,
        customer_tier, customer_age_years, {ts('created_at')} AS created_at, total_accounts, bal / 100.0::DOUBLE AS total_balance_usd, avg_account_balance,
        account_types, total_loans, debt / 100.0::DOUBLE AS total_loan_amount, avg_interest_rate, {CARD_COUNTS}, (bal - debt) / 100.0::DOUBLE AS net_worth,
        debt_to_asset_ratio, financial_health_status, wealth_segment, customer_segment, growth_potential,
        sha256(CAST(customer_id AS VARCHAR)) AS customer_id_hash, {UPDATED} FROM dim""",
    "loan_portfolio": f"""SELECT loan_id, customer_id, customer_name, credit_score::DOUBLE AS credit_score, credit_rating, customer_tier, amt / 100.0::DOUBLE AS loan_amount,
        rate::DOUBLE AS interest_rate, {ts('start_date')} AS start_date, {ts('maturity_date')} AS maturity_date, loan_status, round(payment, 4) AS estimated_monthly_payment,
        total_interest_estimate::DOUBLE AS total_interest_estimate, interest_category, loan_age_months, risk_category,
        round((SELECT quantile_cont(rate::DOUBLE, 0.75) FROM s_loans), 4) AS interest_rate_75th_percentile,
        round((SELECT quantile_cont(amt / 100.0::DOUBLE, 0.9) FROM s_loans), 4) AS loan_amount_90th_percentile,
        round(amt::DOUBLE / (SELECT sum(amt) FROM s_loans) * 100, 4) AS loan_percentage_of_portfolio, income::DOUBLE / 100 AS projected_annual_interest_income,
        {age('start_date')} AS loan_age_years, months_to_maturity, maturity_status, {sk('loan_id', 'start_date')} AS loan_sk FROM portfolio""",
    "loan_portfolio_analysis": f"""SELECT loan_status, risk_category, interest_category, maturity_status, n AS loan_count, amt::DOUBLE / 100 AS total_loan_value,
        {avg6('rate * 100', 'n')} AS avg_interest_rate, round(p50, 4) AS median_interest_rate, round(p90, 4) AS p90_loan_amount, income::DOUBLE / 100 AS total_annual_interest_income,
        {ratio('score', 'scored', 4)} AS avg_borrower_credit_score, rwa::DOUBLE / 1000 AS risk_weighted_assets,
        {ratio('risk_amt * 100', 'all_amt', 2)} AS portfolio_concentration_percentage,
        CASE WHEN risk_category = 'High Risk' AND amt > 100000000 THEN 'Critical Exposure' WHEN risk_category = 'High Risk' THEN 'High Exposure'
             WHEN risk_category = 'Medium Risk' AND amt > 200000000 THEN 'Moderate Exposure' ELSE 'Healthy Portfolio' END AS portfolio_health_status,
        {ratio('income * 100', 'amt', 2)} AS yield_on_portfolio,
        {ratio('(1000000 - ' + rdiv('score', 'scored', 4) + ')', '1000000', 2)} AS estimated_default_risk, {ts(NOW)} AS analysis_timestamp
        FROM (SELECT *, sum(amt) OVER (PARTITION BY risk_category) AS risk_amt, sum(amt) OVER () AS all_amt
              FROM (SELECT loan_status, risk_category, interest_category, maturity_status, count(*) AS n, sum(amt) AS amt, sum(rate) AS rate,
                      quantile_cont(rate::DOUBLE, 0.5) AS p50, quantile_cont(amt / 100.0::DOUBLE, 0.9) AS p90, sum(income) AS income,
                      sum(credit_score) AS score, count(credit_score) AS scored,
                      sum(amt * CASE risk_category WHEN 'High Risk' THEN 15 WHEN 'Medium Risk' THEN 10 ELSE 5 END) AS rwa
                    FROM portfolio GROUP BY ALL))""",
    "transaction_enriched": f"""SELECT {ENRICHED}, round(p75, 4) AS transaction_75th_percentile, running / 100.0::DOUBLE AS cumulative_spend,
        gap AS hours_since_last_transaction FROM enriched""",
    "fct_transactions": f"""SELECT e.* EXCLUDE (amt, running, transaction_date_), s.n AS total_transactions, s.amt / 100.0::DOUBLE AS total_spend,
        s.avg_spend, round(s.p50, 4) AS median_transaction_amount, round(s.c75, 4) AS p75_transaction_amount, round(s.c90, 4) AS p90_transaction_amount,
        s.high AS high_value_transactions, {ratio('s.n', month_diff('s.first_t', 's.last_t'), 2)} AS transactions_per_month,
        e.running / 100.0::DOUBLE AS cumulative_customer_spend,
        CAST(e.transaction_year AS VARCHAR) || '~' || CAST(e.transaction_month AS VARCHAR) || '~' || CAST(customer_id AS VARCHAR) AS period_customer_key,
        sha256(CAST(e.transaction_id AS VARCHAR) || {money_text('e.amt')} || strftime(e.transaction_date_, '%Y-%m-%d %H:%M:%S')) AS transaction_hash, {UPDATED}
        FROM (SELECT {ENRICHED}, amt, running, transaction_date AS transaction_date_ FROM enriched) e LEFT JOIN spend s USING (customer_id)""",
    "fct_account_summary": f"""SELECT account_id, customer_id, customer_name, credit_score, credit_rating, customer_tier, account_type, bal / 100.0::DOUBLE AS current_balance,
        {ts('open_date')} AS open_date, year(open_date) AS open_year, month(open_date) AS open_month, account_age_years, {month_diff('open_date', NOW)} AS account_age_months,
        coalesce(n, 0) AS transaction_count, coalesce(amt, 0) / 100.0::DOUBLE AS total_transaction_amount, coalesce(avg_t, 0) AS avg_transaction_amount,
        round(coalesce(p50, 0), 4) AS median_transaction_amount, coalesce(lo, 0) / 100.0::DOUBLE AS min_transaction_amount, coalesce(hi, 0) / 100.0::DOUBLE AS max_transaction_amount,
        {ts('first_t')} AS first_transaction_date, {ts('last_t')} AS last_transaction_date, coalesce(shops, 0) AS distinct_merchants,
        coalesce(high, 0) AS high_value_transactions, round(coalesce(per_month, 0), 4) AS avg_transactions_per_month, activity_level,
        CASE WHEN amt > 0 THEN {ratio('amt * 100', 'bal', 2)} ELSE 0 END AS turnover_ratio, account_health_status,
        sha256(CAST(account_id AS VARCHAR) || {money_text('bal')} || '2002-01-01 00:00:00') AS account_snapshot_hash, {UPDATED},
        round(balance_90th_percentile, 4) AS balance_90th_percentile, round(balance_median, 4) AS balance_median, balance_category FROM summary""",
    "clv_analysis": f"""SELECT v.customer_id, c.first_name || ' ' || c.last_name AS customer_name, c.credit_score::DOUBLE AS credit_score, c.credit_rating, c.customer_tier,
        n AS total_transactions, amt / 100.0::DOUBLE AS total_spend, avg_spend AS avg_transaction_value, days AS customer_lifetime_days, shops AS unique_merchants,
        clv_c::DOUBLE / 100 AS estimated_clv, {rdiv(rdiv('amt', 'days * 100', 13) + ' * 365', '100000000000', 0)}::DOUBLE / 100 AS annualized_value,
        clv_tier, engagement_score, growth_strategy, {ts(NOW)} AS analysis_date, {UPDATED}
        FROM clv_done v LEFT JOIN s_customers c USING (customer_id)""",
    "calculate_clv": """SELECT customer_id, amt / 100.0::DOUBLE AS total_spend, n AS transaction_count, days AS customer_lifetime_days,
        round(amt / 100.0::DOUBLE / nullif(days, 0) * 365, 4) AS annual_value, amt * 3 / 1000.0::DOUBLE AS estimated_lifetime_value FROM spend""",
    "segment_analysis": f"""SELECT customer_segment, n AS customer_count, bal::DOUBLE / 100 AS total_portfolio_value, {avg6('bal', 'n')} AS avg_balance,
        net::DOUBLE / 100 AS total_net_worth, {ratio('score', 'n', 4)} AS avg_credit_score, round(m1, 4) AS median_balance, round(m2, 4) AS median_net_worth,
        healthy AS healthy_customers, risky AS at_risk_customers, round(healthy::DOUBLE / n * 100, 2) AS health_percentage,
        round(risky::DOUBLE / n * 100, 2) AS risk_percentage, {ratio('bal * 100', 'everything', 2)} AS portfolio_concentration
        FROM (SELECT *, sum(bal) OVER () AS everything FROM
          (SELECT customer_segment, count(*) AS n, sum(bal) AS bal, sum(bal - debt) AS net, sum(CAST(credit_score AS BIGINT)) AS score,
             quantile_cont(bal / 100.0::DOUBLE, 0.5) AS m1, quantile_cont((bal - debt) / 100.0::DOUBLE, 0.5) AS m2,
             count(*) FILTER (financial_health_status = 'Excellent') AS healthy, count(*) FILTER (financial_health_status = 'Needs Attention') AS risky
           FROM dim GROUP BY 1))""",
    "transaction_patterns": patterns("enriched"),
    "event_patterns": patterns("measured_events"),
    "mart_checks": """
        SELECT t AS "table", c AS check_name, f AS failures, CASE WHEN f <> 0 THEN 'error' ELSE 'pass' END AS status FROM (
          SELECT 'dim_customers' AS t, 'unique_customer_id' AS c, (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)) AS f
          UNION ALL SELECT 'dim_customers', 'not_null_customer_id', (SELECT count(*) FROM customer WHERE c_custkey IS NULL)
          UNION ALL SELECT 'fct_transactions', 'unique_transaction_id', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'fct_transactions', 'not_null_transaction_id', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)
          UNION ALL SELECT 'fct_account_summary', 'unique_account_id', (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1))
          UNION ALL SELECT 'fct_account_summary', 'not_null_account_id', (SELECT count(*) FROM customer WHERE c_custkey IS NULL))""",
    "txn_rolling_measures": f"SELECT {MEASURES} FROM measured_events",
    "txn_rolling_measures_split": f"SELECT {MEASURES} FROM measured_events",
    "txn_percentile_bands": """SELECT transaction_id, amt / 100.0::DOUBLE AS amount_usd, round(p95, 4) AS transaction_95th_percentile,
        round(p99, 4) AS transaction_99th_percentile, round(p75, 4) AS transaction_75th_percentile,
        CASE WHEN amt / 100.0::DOUBLE > p95 THEN 'High Value' WHEN amt / 100.0::DOUBLE > p75 THEN 'Above Average' ELSE 'Normal' END AS value_category FROM s_txn CROSS JOIN marks""",
    "customer_wealth_rank_ntile": "SELECT customer_id, bal::DOUBLE / 100 AS total_balance_usd, balance_rank, wealth_quintile FROM totals JOIN scores USING (customer_id)",
    "order_priority_rank_ntile": """SELECT o_orderkey, o_orderpriority, rank() OVER (ORDER BY o_orderpriority DESC) AS priority_rank,
        ntile(7) OVER (ORDER BY o_orderpriority DESC, o_orderkey) AS priority_tile FROM orders""",
    "segment_price_percentiles": """SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) AS median_price,
        round(quantile_cont(o_totalprice, 0.9), 4) AS p90_price FROM orders GROUP BY 1""",
    "order_price_percentiles_narrowed": " UNION ALL ".join(
        f"""SELECT {k} AS o_orderstatus, round(quantile_cont(o_totalprice, 0.0), 4) AS least_price, round(quantile_cont(o_totalprice, 0.01), 4) AS p01_price,
        round(quantile_cont(o_totalprice, 0.5), 4) AS median_price, round(quantile_cont(o_totalprice, 1.0), 4) AS top_price FROM orders GROUP BY 1"""
        for k in ("'all'", "o_orderstatus")
    ),
    "latest_event_of_user": """WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN 'nan'::DOUBLE ELSE value END AS worth,
            CASE WHEN event_id % 5 = 0 THEN -9223372036854775808 ELSE event_id END AS code FROM events),
        a AS (SELECT user_id, event_id FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY worth DESC NULLS LAST, event_id) = 1),
        b AS (SELECT user_id, event_id AS by_code FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY code DESC, event_id) = 1)
        SELECT a.user_id, a.event_id, b.by_code FROM a JOIN b USING (user_id)""",
    "flag_price_percentiles_split": """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price,
        round(quantile_cont(l_extendedprice, 0.99), 4) AS p99_price, round(quantile_cont(l_quantity, 0.5), 4) AS median_qty FROM lineitem GROUP BY 1""",
    "flag_quantity_percentiles_counted": """SELECT l_returnflag, form, p10_qty, median_qty, p99_discount FROM (SELECT l_returnflag, round(quantile_cont(l_quantity, 0.1), 4) AS p10_qty,
        round(quantile_cont(l_quantity, 0.5), 4) AS median_qty, round(quantile_cont(l_discount, 0.99), 4) AS p99_discount FROM lineitem GROUP BY 1)
        CROSS JOIN (VALUES ('narrowed'), ('built in')) f(form)""",
    "customer_figures_in_batches": """SELECT customer_id, n AS total_transactions, amt / 100.0::DOUBLE AS total_spend, high AS high_value_transactions,
        round(p50, 4) AS median_transaction_amount, round(c75, 4) AS p75_transaction_amount, round(c90, 4) AS p90_transaction_amount FROM spend WHERE customer_id IS NOT NULL""",
    "order_running_total": f"""SELECT o_orderkey, {ts('o_orderdate')} AS o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
        CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_cents FROM orders""",
    "star_projection": "SELECT c_custkey AS x_c_custkey_y, c_name AS x_c_name_y, c_nationkey AS x_c_nationkey_y, c_mktsegment AS x_c_mktsegment_y FROM customer",
    "staging_columns": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "nullcheck": "SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "group_by_first_columns": "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2",
    "mask_customers": """SELECT customer_id, left(email, 3) || '********' || right(email, 4) AS email_masked,
        left(first_name, 3) || '********' || right(first_name, 4) AS first_name_masked, sha256(email) AS email_hash, sha256(first_name) AS first_name_hash
        FROM (SELECT c_custkey AS customer_id, lower(c_name) || '@bank.example' AS email, c_name AS first_name FROM customer)""",
    "surrogate_keys": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_returnflag, 'N') AS flag,
        {sk('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', "nullif(l_returnflag, 'N')")} AS line_sk FROM lineitem""",
    "surrogate_key_report": f"""SELECT {sk('l_orderkey', 'l_linenumber')} AS surrogate_key, count(*) AS n_rows, 1 AS n_inputs, false AS is_collision
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "business_keys": """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '~' || nullif(o_orderstatus, 'P') || '~' || o_orderpriority AS order_key,
        sha256(CAST(o_custkey AS VARCHAR)) AS customer_hash FROM orders""",
    "dedupe_latest_order": f"""SELECT * REPLACE ({ts('o_orderdate')} AS o_orderdate, round(o_totalprice, 4) AS o_totalprice) FROM (SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""",
    "dedupe_first_event": f"""SELECT * REPLACE ({ts('ts')} AS ts, round(value, 4) AS value) FROM (SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) = 1)""",
    "pivot_priority_counts": "SELECT o_orderstatus, "
    + ", ".join(
        f"count(*) FILTER (o_orderpriority = '{v}') AS {n}"
        for v, n in [
            ("1-URGENT", "n_1_urgent"), ("2-HIGH", "n_2_high"), ("3-MEDIUM", "n_3_medium"), ("4-NOT SPECIFIED", "n_4_not_specified"), ("5-LOW", "n_5_low"),
        ]
    )
    + " FROM orders GROUP BY 1",
    "pivot_quantity_sums": """SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS A_qty,
        sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS N_qty, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS R_qty FROM lineitem GROUP BY 1""",
    "unpivot_lineitem_measures": """SELECT l_orderkey, l_linenumber, 'l_partkey' AS prop, CAST(l_partkey AS VARCHAR) AS val FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', l_returnflag FROM lineitem""",
    "union_relations_people": """SELECT 'customer' AS _dbt_source_relation, c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS nation FROM customer WHERE c_name NOT LIKE '%7'
        UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_name NOT LIKE '%7'""",
    "union_relations_exclude": """SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey FROM orders
        UNION ALL SELECT l_orderkey, l_linestatus, NULL FROM lineitem""",
    "relations_by_prefix_union": "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'",
    "series_orders_without_lines": """SELECT g AS generated_number FROM (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders))) AS g)
        WHERE g NOT IN (SELECT l_orderkey FROM lineitem)""",
    "date_spine_daily_orders": f"""SELECT s.o_orderstatus, {day('g.p')} AS order_day, count(o.o_orderkey) AS n_orders, count(DISTINCT o.o_custkey) AS n_customers
        FROM (SELECT DISTINCT o_orderstatus FROM orders) s CROSS JOIN ({GRID.format('1994-12-25', '2002-01-09', 'DAY')}) g
        LEFT JOIN orders o ON o.o_orderstatus = s.o_orderstatus AND o.o_orderdate = g.p GROUP BY s.o_orderstatus, g.p""",
    "date_spine_hourly_events": f"""SELECT {ts('g.p')} AS event_hour, count(e.event_id) AS n_events
        FROM ({GRID.format('2024-01-01', '2024-01-31 23:00:00', 'HOUR')}) g LEFT JOIN events e ON date_trunc('hour', e.ts) = g.p GROUP BY g.p""",
    "date_spine_monthly_orders": f"""SELECT {day('g.p')} AS order_month, count(o.o_orderkey) AS n_orders
        FROM ({GRID.format('1995-01-01', '2002-12-01', 'MONTH')}) g LEFT JOIN orders o ON date_trunc('month', o.o_orderdate) = g.p GROUP BY g.p""",
    "column_value_freq": "SELECT l_suppkey AS value, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1 ORDER BY n DESC, value LIMIT 25",
    "single_value": "SELECT round(max(o_totalprice), 4) AS largest, -1.0::DOUBLE AS absent FROM orders",
    "share_of_total": """SELECT o_orderkey, round(CAST(round(o_totalprice * 100) AS BIGINT)::DOUBLE
        / (SELECT sum(CAST(round(o_totalprice * 100) AS BIGINT)) FROM orders)::DOUBLE * 1000000, 4) AS share_ppm FROM orders""",
    "price_histogram": """SELECT CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 17
        ELSE CAST(floor((l_extendedprice - 10000) / 5000) AS BIGINT) + 1 END AS bucket, count(*) AS n,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1""",
    "net_totals": """SELECT l_returnflag, CAST(q + n + s AS BIGINT) AS net_sum, CAST(q - n - s AS BIGINT) AS net_difference, round(q::DOUBLE / nullif(n + s, 0)::DOUBLE, 4) AS net_ratio
        FROM (SELECT l_returnflag, sum(CASE WHEN l_quantity <> 7 THEN CAST(l_quantity AS BIGINT) END) AS q, sum(l_linenumber) AS n, sum(l_suppkey) AS s FROM lineitem GROUP BY 1)""",
    "safe_arithmetic": """SELECT l_linenumber, CAST(sum(q + n + l_suppkey) AS BIGINT) AS added, CAST(sum(q - n - l_suppkey) AS BIGINT) AS subtracted,
        count(CASE WHEN l_suppkey % 10 <> 0 THEN nullif(q, 0) END) AS divided,
        round(sum(CASE WHEN l_suppkey % 10 <> 0 THEN nullif(q, 0)::DOUBLE / (l_suppkey % 10) END), 4) AS quotients
        FROM (SELECT l_linenumber, l_suppkey, CASE WHEN l_quantity = 5 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS q,
                CASE WHEN l_linenumber = 2 THEN 0 ELSE l_linenumber END AS n FROM lineitem) GROUP BY 1""",
    "url_host_counts": "SELECT host, count(*) AS n_pages FROM hosts GROUP BY 1",
    "url_path_counts": "SELECT host, path, n_pages FROM path_n",
    "url_top_paths": """SELECT host, path, n_pages, rank FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n_pages DESC, path) AS rank FROM path_n) WHERE rank <= 2""",
    "url_param_counts": """SELECT nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source, count(*) AS n_pages FROM pages GROUP BY 1""",
    "proximity_pairs": f"""SELECT left_id, right_id, round(d, 4) AS distance FROM (
        SELECT a.left_id, b.right_id, 2 * 3961 * asin(sqrt(least(1.0, pow(sin(radians((b.lat - a.lat) / 2)), 2)
          + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians((b.lon - a.lon) / 2)), 2)))) * 1.60934 AS d
        FROM (SELECT c_custkey AS left_id, {point('c_custkey')} FROM customer) a CROSS JOIN (SELECT s_suppkey AS right_id, {point('s_suppkey')} FROM supplier) b) WHERE d <= 300""",
    "partitioned_table_by_month": """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
        CASE WHEN year(o_orderdate) = 1995 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders GROUP BY ALL""",
    "rebuild_table_in_place": "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal * 2, 4) AS s_acctbal FROM supplier",
    "upsert_orders": """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE o_orderstatus || '2' END AS o_orderstatus,
        year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders""",
    "upsert_moved_rows": """SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'TOOLS' ELSE c_mktsegment END AS c_mktsegment,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END AS vip FROM customer""",
    "upsert_sync_columns": "SELECT p_partkey, p_size, CASE WHEN p_size > 25 THEN 'big' END AS label FROM part",
    "newer_than_mark": f"""SELECT o_orderkey, {ts('o_orderdate')} AS o_orderdate FROM orders
        WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')""",
    "unread_files_of_orders": f"SELECT o_orderkey, {ts('o_orderdate')} AS o_orderdate, round(o_totalprice, 4) AS o_totalprice FROM orders",
    "csv_rejects_of_orders": """WITH l AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus = 'P' OR o_orderpriority = '5-LOW' AS bad FROM orders)
        SELECT CASE WHEN NOT bad THEN o_orderkey END AS o_orderkey, CASE WHEN NOT bad THEN o_custkey END AS o_custkey, CASE WHEN NOT bad THEN cents END AS cents,
        CASE WHEN NOT bad THEN o_orderpriority END AS o_orderpriority, CASE WHEN bad THEN concat_ws(',', o_orderkey, o_custkey,
        CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(cents AS VARCHAR) END, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END) END AS record FROM l""",
    "sql_text_functions": f"""SELECT CAST(CAST(m.m AS DATE) AS VARCHAR) AS date_month, c_mktsegment || '~' || o_orderpriority AS business_key,
        min(substr(c_name, 1, 3) || '********' || right(c_name, 4)) AS masked, count(o_orderkey) AS n_orders, floor(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / nullif(count(o_orderkey), 0)) AS mean_cents,
        min({sk('c_mktsegment', 'o_orderpriority')}) AS first_key
        FROM (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2002-12-01', INTERVAL 1 MONTH)) AS m) m
        LEFT JOIN orders ON date_trunc('month', o_orderdate) = m.m LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL""",
    "incremental_affected_customers": f"""SELECT o_orderkey, o_custkey, {ts('o_orderdate')} AS o_orderdate FROM orders
        WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')""",
    "stream_upsert_orders": """SELECT k AS arrival, o_custkey, o_orderkey, o_orderstatus
        FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) CROSS JOIN (VALUES (0::BIGINT), (1)) AS v(k)""",
    "upsert_null_keys": "SELECT nullif(o_orderpriority, '1-URGENT') AS priority, count(*) AS n FROM orders GROUP BY 1",
    "upsert_other_bucket_count": "SELECT c_custkey, c_mktsegment, true AS refused FROM customer",
    "upsert_added_column": """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS label,
        o_orderstatus <> 'P' AS untouched FROM orders""",
    "view_of_orders": "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL",
    "relation_types": """SELECT event_type AS name, CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN 'external' ELSE 'table' END AS table_type
        FROM events GROUP BY 1, 2 UNION ALL SELECT 'shown', 'view'""",
    "order_inside_files": "SELECT o_orderstatus, count(*) AS n, 0::BIGINT AS n_out_of_order FROM orders GROUP BY 1",
    "proximity_same_place": "SELECT c_custkey AS left_id, s_suppkey AS right_id, 0.0::DOUBLE AS distance FROM customer JOIN supplier ON c_custkey % 97 = s_suppkey % 97",
    "dedupe_mixed_text": """SELECT o_custkey, o_orderkey, nullif(o_orderstatus, 'P') AS s, o_orderpriority FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderstatus, 'P') DESC NULLS LAST, o_orderpriority DESC, o_orderkey) = 1""",
    "pivot_top_suppliers": """SELECT l_returnflag, 's_' || CAST(l_suppkey AS VARCHAR) AS supplier, count(*) AS n FROM lineitem
        WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey DESC LIMIT 5) GROUP BY ALL""",
    "forms_of_windows": FORMS.format("(SELECT count(*) FROM events)"),
    "forms_of_percentiles": FORMS.format("(SELECT count(DISTINCT l_suppkey) FROM lineitem)"),
    "forms_of_ranges": FORMS.format("""(SELECT count(*) FROM (SELECT hi, lead(lo) OVER (PARTITION BY k ORDER BY lo, hi) AS nxt FROM (SELECT o_custkey AS k,
        CAST(o_orderdate AS DATE) AS lo, CAST(o_orderdate AS DATE) + 200 AS hi FROM orders)) WHERE NOT (hi < nxt))"""),
    "forms_of_sequences": FORMS.format("""(SELECT count(*) FROM (SELECT l_orderkey, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS p
        FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)) WHERE l_orderkey <> p + 1)"""),
    "forms_of_proximity": FORMS.format(f"""(SELECT count(*) FROM (
        SELECT 2 * 3961 * asin(sqrt(least(1.0, pow(sin(radians((b.lat - a.lat) / 2)), 2)
          + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians((b.lon - a.lon) / 2)), 2)))) * 1.60934 AS d
        FROM (SELECT {point('c_custkey')} FROM customer) a CROSS JOIN (SELECT {point('s_suppkey')} FROM supplier) b) WHERE d <= 700)"""),
    "date_spine_minutely_events": f"""SELECT t.event_type, {ts('g.p')} AS minute, count(e.event_id) AS n_events
        FROM ({GRID.format('2024-01-01', '2024-01-31 23:59:00', 'MINUTE')}) g CROSS JOIN (SELECT DISTINCT event_type FROM events) t
        LEFT JOIN events e ON date_trunc('minute', e.ts) = g.p AND e.event_type = t.event_type GROUP BY ALL""",
    "check_accepted_range": "SELECT * FROM lines WHERE NOT (l_quantity > 2 AND l_quantity < 49)",
    "check_at_least_one": "SELECT o_custkey, 0 AS filler_column FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderpriority = '1-URGENT') = 0",
    "check_at_least_one_table": "SELECT count(*) AS filler_column FROM orders WHERE o_totalprice < 0 HAVING count(*) = 0",
    "check_cardinality_equality": """WITH a AS (SELECT c_custkey, count(*) AS num_rows FROM customer GROUP BY 1), b AS (SELECT o_custkey, count(*) FROM orders GROUP BY 1)
        (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "check_equal_rowcount": """SELECT a.k AS k_a, b.k AS k_b, count_a, count_b, abs(count_a - count_b) AS diff_count
        FROM (SELECT o_orderkey AS k, count(*) AS count_a FROM orders GROUP BY 1) a FULL JOIN (SELECT l_orderkey AS k, count(*) AS count_b FROM lineitem GROUP BY 1) b ON a.k = b.k""",
    "check_equal_rowcount_table": """SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count FROM (SELECT count(*) AS a FROM orders) CROSS JOIN (SELECT count(*) AS b FROM lineitem)""",
    "check_equality": """WITH a AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders), b AS (SELECT c_custkey AS k, 'O' AS s FROM customer)
        SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "check_equality_exact": """WITH a AS (SELECT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer)
        SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "check_equality_by_checksum": """WITH a AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_returnflag FROM lineitem),
        b AS (SELECT * REPLACE (CASE WHEN l_extendedprice > 104500 THEN 0.5 ELSE l_discount END AS l_discount) FROM a), ab AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
        ba AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a), d AS (SELECT 'a_minus_b' AS which_diff, * FROM ab UNION ALL SELECT 'b_minus_a', * FROM ba)
        SELECT * REPLACE (round(l_extendedprice, 4) AS l_extendedprice, round(l_discount, 4) AS l_discount) FROM d""",
    "check_cardinality_by_checksum": """WITH a AS (SELECT l_orderkey, count(*) AS num_rows FROM lineitem GROUP BY 1),
        b AS (SELECT l_orderkey, count(*) FROM lineitem WHERE l_extendedprice <= 104500 GROUP BY 1)
        (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "check_overlapping_ranges": """SELECT k AS partition_by_col, CAST(lo AS VARCHAR) AS lower_bound, CAST(hi AS VARCHAR) AS upper_bound, CAST(top AS VARCHAR) AS reached
        FROM (SELECT *, max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
        FROM (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS lo, CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 500) AS INT) AS hi FROM orders) WHERE lo < hi)
        WHERE lo < top""",
    "check_overlapping_ranges_table": """SELECT lo AS lower_bound, hi AS upper_bound, top AS reached
        FROM (SELECT *, max(hi) OVER (ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
        FROM (SELECT o_orderkey AS lo, o_orderkey + CASE WHEN o_totalprice > 400000 THEN 50 ELSE 1 END AS hi FROM orders)) WHERE lo < top""",
    "check_expression_is_true": "SELECT * FROM lines WHERE NOT (l_discount < 0.09::DOUBLE AND l_returnflag <> 'R')",
    "check_expression_on_column": "SELECT * FROM lines WHERE NOT (l_quantity + l_linenumber <= 50)",
    "check_fewer_rows_than": """SELECT a.k AS k_a, b.k AS k_b, a.n AS count_our_model, b.n AS count_comparison_model,
        CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta
        FROM (SELECT o_custkey AS k, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) b ON a.k = b.k""",
    "check_mutually_exclusive_ranges": """SELECT k AS partition_by_col, CAST(lo AS VARCHAR) AS lower_bound, CAST(hi AS VARCHAR) AS upper_bound, CAST(nxt AS VARCHAR) AS next_lower_bound,
        nxt IS NULL AS is_last_record, lo < hi AS lower_bound_less_than_upper_bound, coalesce(hi < nxt, true) AS upper_bound_less_than_next_lower_bound
        FROM (SELECT *, lead(lo) OVER (PARTITION BY k ORDER BY lo, hi) AS nxt FROM (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS lo, CAST(o_orderdate AS DATE) + 200 AS hi FROM orders))
        WHERE NOT (hi < nxt)""",
    "check_mutually_exclusive_ranges_table": """SELECT lo AS lower_bound, hi AS upper_bound, nxt AS next_lower_bound, false AS is_last_record,
        true AS lower_bound_less_than_upper_bound, false AS upper_bound_equal_to_next_lower_bound
        FROM (SELECT *, lead(lo) OVER (ORDER BY lo, hi) AS nxt FROM (SELECT o_orderkey AS lo, o_orderkey + CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END AS hi FROM orders))
        WHERE hi <> nxt""",
    "check_not_accepted_values": "SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', '9-NEVER')",
    "check_accepted_values": "SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1",
    "check_not_constant": "SELECT o_custkey, 1 AS filler_column FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1",
    "check_not_empty_string": "SELECT l_orderkey, '   ' AS flag FROM lineitem WHERE l_returnflag = 'R'",
    "check_not_null": "SELECT l_orderkey, CAST(NULL AS BIGINT) AS n FROM lineitem WHERE l_linenumber = 4",
    "check_not_null_proportion": """SELECT o_custkey, round(v::DOUBLE / n, 4) AS not_null_proportion FROM (SELECT o_custkey,
        count(*) FILTER (o_orderstatus <> 'P') AS v, count(*) AS n FROM orders GROUP BY 1) WHERE v::DOUBLE / n < 0.5 OR v::DOUBLE / n > 0.9""",
    "check_recency": f"""SELECT user_id, {ts('m')} AS most_recent, {ts("TIMESTAMP '2024-01-29 06:00:00'")} AS threshold
        FROM (SELECT user_id, max(ts) AS m FROM events GROUP BY 1) WHERE m < TIMESTAMP '2024-01-29 06:00:00'""",
    "check_recency_dates": """SELECT o_custkey, strftime(m, '%Y-%m-%d') AS most_recent, '2001-07-01' AS threshold
        FROM (SELECT o_custkey, max(o_orderdate) AS m FROM orders GROUP BY 1) WHERE CAST(m AS DATE) < DATE '2001-07-01'""",
    "check_relationships_where": """SELECT o_orderkey AS id, CAST(NULL AS BIGINT) AS right_id FROM orders WHERE o_orderstatus <> 'P'
        AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'N')""",
    "check_sequential_values": """SELECT l_orderkey, p AS previous_l_orderkey FROM (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS p
        FROM (SELECT DISTINCT l_orderkey FROM lineitem)) WHERE l_orderkey <> p + 1""",
    "check_sequential_timestamps": f"""SELECT o_custkey, {ts('d')} AS d, {ts('p')} AS previous_d FROM (SELECT o_custkey, o_orderdate AS d,
        lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS p FROM orders) WHERE d <> p + INTERVAL 1 MONTH""",
    "check_unique_combination": "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "check_unique": "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1",
    "check_assert_equal": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) % 7 AS q FROM lineitem WHERE CAST(l_quantity AS BIGINT) % 7 <> l_linenumber",
    "check_suite_lineitem": """SELECT 'lineitem' AS "table", c AS check_name, CAST(f AS BIGINT) AS failures, s AS status FROM (
        SELECT 'not_null_l_orderkey' AS c, count(*) FILTER (l_orderkey IS NULL) AS f, CASE WHEN count(*) FILTER (l_orderkey IS NULL) = 0 THEN 'pass' ELSE 'error' END AS s FROM lineitem
        UNION ALL SELECT 'accepted_range_l_discount', count(*) FILTER (NOT (l_discount >= 0 AND l_discount <= 0.09::DOUBLE)), 'error' FROM lineitem
        UNION ALL SELECT 'accepted_range_l_tax', count(*) FILTER (NOT (l_tax >= 0 AND l_tax <= 0.05::DOUBLE)), 'warn' FROM lineitem
        UNION ALL SELECT 'quantity_positive', count(*) FILTER (l_returnflag = 'R' AND l_quantity <= 0), 'pass' FROM lineitem
        UNION ALL SELECT 'some_returned', count(*) FILTER (l_returnflag = 'R'), 'pass' FROM lineitem
        UNION ALL SELECT 'unique_l_orderkey', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)), 'warn'
        UNION ALL SELECT 'unique_line', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 'error'
        UNION ALL SELECT 'line_has_order', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)), 'pass'
        UNION ALL SELECT 'as_many_lines_as_orders', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders), 'error'
        UNION ALL SELECT 'fewer_lines_than_orders', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders), 'error'
        UNION ALL SELECT 'columns', 2, 'error')""",
}



def assemble(statement: str) -> str:
    """The statement with every shared subquery it needs in front of it."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        text = pending.pop()
        for name, body in SUBQUERIES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(body)
    if not needed:
        return statement
    shared = ",\n".join(f"{name} AS ({body})" for name, body in SUBQUERIES.items() if name in needed)
    return f"WITH {shared}\n{statement}"


QUERY_SQL["refresh_in_batches"] = QUERY_SQL["fct_transactions"]
QUERY_SQL["refresh_accounts_in_batches"] = QUERY_SQL["fct_account_summary"]
QUERY_SQL["refresh_clv_in_batches"] = f"SELECT * FROM ({QUERY_SQL['clv_analysis']}) WHERE customer_id IS NOT NULL"

# loaded from CSV, keys stay text
for _source, _keys in {
    "customers": ["customer_id"],
    "accounts": ["account_id", "customer_id"],
    "branches": ["branch_id"],
    "cards": ["card_id", "account_id"],
    "loans": ["loan_id", "customer_id"],
    "merchants": ["merchant_id"],
    "transactions": ["transaction_id", "account_id", "merchant_id"],
}.items():
    _text = ", ".join(f"CAST({k} AS VARCHAR) AS {k}" for k in _keys)
    QUERY_SQL[f"csv_load_{_source}"] = f"SELECT * REPLACE ({_text}) FROM ({QUERY_SQL[f'stg_{_source}']})"

for _part, _start, _end in (("week", "1994-12-26", "2002-12-30"), ("quarter", "1995-01-01", "2002-10-01"), ("year", "1994-01-01", "2002-01-01")):
    _every = {"week": "7 DAY", "quarter": "3 MONTH", "year": "1 YEAR"}[_part]
    _grid = f"SELECT CAST(generate_series AS TIMESTAMP) AS p FROM generate_series(TIMESTAMP '{_start}', TIMESTAMP '{_end}', INTERVAL {_every})"
    QUERY_SQL[f"date_spine_orders_per_{_part}"] = f"""SELECT s.o_orderstatus, {day('g.p')} AS starts_on, count(o.o_orderkey) AS n_orders
        FROM ({_grid}) g CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders) s
        LEFT JOIN orders o ON date_trunc('{_part}', o.o_orderdate) = g.p AND o.o_orderstatus = s.o_orderstatus GROUP BY ALL"""

# Columns that DuckDB has as 32-bit integers; results are compared as 64-bit ones.
NARROW = {
    "check_at_least_one": "filler_column",
    "check_not_constant": "filler_column",
    "clv_analysis": "engagement_score",
    "rebuild_table_in_place": "s_nationkey",
    "refresh_clv_in_batches": "engagement_score",
    "staging_columns": "s_nationkey",
    "star_projection": "x_c_nationkey_y",
    "surrogate_key_report": "n_inputs",
    "upsert_moved_rows": "vip",
    "upsert_sync_columns": "p_size",
}
for _name in """check_accepted_range check_assert_equal check_expression_is_true check_expression_on_column check_unique_combination
        safe_arithmetic surrogate_keys unpivot_lineitem_measures""".split():
    NARROW[_name] = "l_linenumber"


def widened(name: str, statement: str) -> str:
    column = NARROW.get(name)
    return f"SELECT * REPLACE (CAST({column} AS BIGINT) AS {column}) FROM ({statement})" if column else statement


ORACLES = {name: assemble(widened(name, statement)) for name, statement in QUERY_SQL.items()}
