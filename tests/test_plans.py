"""The bank plans on hand-made rows at the edges of every rule."""

import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import accounts as account_plans, analytics, customers as customer_plans, loans as loan_plans, quality, refresh, staging, state, transactions as txn_plans
from ledgerloom.session import materialise, setting
from ledgerloom.sources import tables
from ledgerloom.sources.registry import SCHEMAS

AS_OF = "2024-07-01 12:00:00"


def raw(spark, name, *data):
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in row) for row in data], SCHEMAS[name])


@pytest.fixture(scope="module")
def customers(spark):
    scores = [None, 579, 580, 669, 670, 739, 740, 799, 800, "abc", 1000]
    people = [(i, f"F{i}", f"L{i}", f"user{i}@bank.example", "Oslo", s, "2015-01-01") for i, s in enumerate(scores)]
    people += [(20, "New", "One", None, None, 750, "2024-01-01"), (21, "Odd", "Date", "x@y", "Bergen", 700, "not a date"), (22, "Tie", "A", "t@a", "Oslo", 690, "2020-06-01")]
    return staging.stg_customers(raw(spark, "customers", *people), AS_OF).cache()


@pytest.fixture(scope="module")
def accounts(spark):
    held = [
        (1, 0, "Savings", "100.00", "2010-01-01"), (2, 0, "Current", "50.005", "2023-01-01"), (3, 1, "Savings", "0", "2012-01-01"),
        (4, 2, "Savings", "-20", "2019-05-05"), (5, 8, "Current", "150000", "2018-01-01"), (6, 7, "Current", "60000", "2018-01-01"),
        (7, 22, "Savings", "150.01", "2020-01-01"), (8, None, "Savings", "5", "2020-01-01"), (9, 5, "Savings", "n/a", "2020-01-01"),
        (10, 6, "Savings", "15000", "2020-01-01"), (11, 6, "Savings", "15000", "2020-01-01"),
    ]
    return staging.stg_accounts(raw(spark, "accounts", *held)).cache()


@pytest.fixture(scope="module")
def loans(spark):
    lent = [
        (1, 1, "6000", "0", "2023-01-01"), (2, 2, "6000", "7", "2019-07-01 12:00:00"), (3, 2, "6000", "10", "2019-07-01 11:59:59"),
        (4, 0, "1000", "10.5", "2020-07-01"), (5, 8, "100", "7.5", "2021-07-01"), (6, 99, "500", "12", "2022-07-02"), (7, 0, "x", "y", "z"),
    ]
    return staging.stg_loans(raw(spark, "loans", *lent), AS_OF).cache()


@pytest.fixture(scope="module")
def cards(spark):
    issued = [
        (1, 1, "Credit", "2024-07-01 11:59:59"), (2, 1, "Debit", "2024-07-01 12:00:00"), (3, 2, "Credit", "2024-10-31"),
        (4, 3, "Prepaid", "2024-11-02"), (5, 77, "Credit", "2030-01-01"), (6, 4, "Debit", "never"),
    ]
    return staging.stg_cards(raw(spark, "cards", *issued), AS_OF).cache()


def by(df, key, *columns):
    return {r[0]: (r[1] if len(columns) == 1 else tuple(r[1:])) for r in df.select(key, *columns).collect()}


def test_staged_customers(customers):
    ratings = by(customers, "customer_id", "credit_rating")
    assert [ratings[str(i)] for i in range(11)] == ["Bad", "Bad", "Poor", "Poor", "Fair", "Fair", "Good", "Good", "Excellent", "Bad", "Bad"]
    tiers = by(customers, "customer_id", "customer_tier", "customer_age_years")
    assert tiers["6"] == ("Platinum", 9) and tiers["4"] == ("Gold", 9) and tiers["1"] == ("Silver", 9)
    assert tiers["20"] == ("Bronze", 0) and tiers["21"] == ("Bronze", None)
    private = by(customers, "customer_id", "email_masked", "email_raw")
    assert private["1"] == ("use********mple", "user1@bank.example") and private["20"] == (None, None)


def test_staged_accounts_and_branches(spark, accounts, rows):
    assert by(accounts, "account_id", "balance_usd")["2"] == D("50.01") and by(accounts, "account_id", "balance_usd")["9"] is None
    staged = staging.stg_branches(raw(spark, "branches", (1, "Main", "", "", "NO"), (2, "Side", "Bo", "Oslo", "")))
    assert rows(staged, "branch_id", "manager_name", "city", "country") == [("1", "", None, "NO"), ("2", "Bo", "Oslo", None)]


def test_staged_cards(cards):
    got = by(cards, "card_id", "is_expired", "months_until_expiry")
    assert got["1"] == (True, 0) and got["2"] == (False, 0) and got["3"] == (False, 3) and got["4"] == (False, 4)
    assert got["6"] == (False, None)


def test_staged_loans(loans):
    got = by(loans, "loan_id", "loan_status", "interest_category", "estimated_monthly_payment", "total_interest_estimate")
    assert got["1"] == ("Active", "Low Interest", 100.0, D("0.00"))
    growth = 1.07**60
    payment = round(6000 * 0.07 * growth / (growth - 1), 2)
    assert got["2"] == ("Near Maturity", "Medium Interest", payment, D(str(payment)) * 60 - 6000)
    assert got["3"][:2] == ("Completed", "High Interest")
    assert [got[i][0] for i in "456"] == ["Near Maturity", "Mid-Term", "Active"]
    assert got["7"] == ("Recent", "Low Interest", None, None)
    monthly = staging.stg_loans(loans.select("loan_id", "customer_id", "loan_amount", "interest_rate", "start_date"), AS_OF, periods_per_year=12)
    growth = (1 + 0.07 / 12) ** 60
    assert by(monthly, "loan_id", "estimated_monthly_payment")["2"] == round(6000 * 0.07 / 12 * growth / (growth - 1), 2)


def test_staged_transactions(spark):
    at = lambda h: f"2024-03-04 {h:02d}:00:00"
    data = [(h, 1, 1, "5", at(h)) for h in (0, 5, 6, 11, 12, 17, 18, 23)]
    data += [(30 + i, 1, 1, a, at(1)) for i, a in enumerate(["99.99", "100", "999.99", "1000", "9999.99", "10000", "x"])]
    data += [(40, 1, 1, 1, "2023-12-25 08:00:00"), (41, 1, 1, 1, "2024-01-01"), (42, 1, 1, 1, "2024-03-08"), (43, 1, 1, 1, "2024-03-10"), (44, 1, 1, 1, "?")]
    staged = staging.stg_transactions(raw(spark, "transactions", *data))
    time = by(staged, "transaction_id", "time_of_day")
    assert [time[str(h)] for h in (0, 5, 6, 11, 12, 17, 18, 23)] == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]
    size = by(staged, "transaction_id", "transaction_size")
    assert [size[str(30 + i)] for i in range(7)] == ["Micro", "Low Value", "Low Value", "Medium Value", "Medium Value", "High Value", "Micro"]
    days = by(staged, "transaction_id", "is_holiday", "day_type", "transaction_time")
    assert days["40"] == (True, "Weekday", "08:00:00") and days["41"][0] and days["42"][1] == "Weekend" and days["43"][1] == "Weekday"
    assert days["44"] == (False, "Weekday", None) and time["44"] == "Night"
    sunday = staging.stg_transactions(raw(spark, "transactions", *data), weekend_days=(1, 7))
    assert by(sunday, "transaction_id", "day_type")["43"] == "Weekend"


@pytest.fixture(scope="module")
def c360(customers, accounts, loans, cards):
    return customer_plans.customer_360(customers, accounts, loans, cards, partitions=3).cache()


def test_customer_360(c360):
    assert c360.count() == 14
    got = {r.customer_id: r for r in c360.collect()}
    zero = got["0"]
    assert (zero.total_accounts, zero.total_balance_usd, zero.account_types) == (2, D("150.01"), "Current, Savings")
    assert (zero.total_loans, zero.total_loan_amount) == (2, D("1000.00"))  # the unreadable loan has no amount
    assert (zero.total_cards, zero.credit_cards, zero.debit_cards, zero.expired_cards, zero.cards_expiring_soon) == (3, 2, 1, 1, 2)
    assert (zero.net_worth, zero.debt_to_asset_ratio, zero.financial_health_status) == (D("-849.99"), D("0.15"), "Needs Attention")
    # 0 and 22 tie at 150.01: one rank, tiles by id
    assert got["22"].balance_rank == zero.balance_rank == 4
    alone = got["3"]
    assert (alone.total_accounts, alone.total_balance_usd, alone.balance_rank, alone.financial_health_status) == (0, 0, None, "Needs Attention")
    # eight holders, NULL owner included: 2, 2, 2, 1, 1 per fifth
    assert [got[i].wealth_quintile for i in ("8", "7", "6")] == [1, 1, 2]
    assert got["5"].total_balance_usd == 0 and got["5"].balance_rank == 9 and got["20"].customer_business_key is None
    assert got["8"].credit_score_90th_percentile == pytest.approx(got["0"].credit_score_90th_percentile)


def test_dim_customers(c360):
    dim = customer_plans.dim_customers(c360, AS_OF)
    got = by(dim, "customer_id", "customer_segment", "wealth_segment", "growth_potential")
    assert got["8"][:2] == ("Premium", "Top 20%") and got["7"][0] == "High Value" and got["6"][0] == "Standard"
    assert got["1"][0] == "Basic" and got["3"][1] == "Bottom 20%"
    assert got["6"][2] == "Upsell Opportunity" and got["2"][2] == "Risk" and got["20"][2] == "Upsell Opportunity" and got["0"][2] == "Stable"


def test_card_info(customers, accounts, cards):
    info = customer_plans.customer_card_info(customers, accounts, cards, AS_OF)
    rows_of = {(r.customer_id, r.card_id): r for r in info.collect()}
    assert rows_of["0", "1"].card_status == "Expired" and rows_of["0", "2"].card_status == "Expiring Soon"
    assert rows_of["0", "3"].card_status == "Expiring Soon" and rows_of["1", "4"].card_status == "Active" and rows_of["1", "4"].card_category == "Other"
    bare = rows_of["20", None]
    assert (bare.account_id, bare.card_status, bare.card_category) == (None, "Active", "Other")


def test_loan_portfolio(loans, customers):
    portfolio = loan_plans.loan_portfolio(loans, customers, AS_OF).cache()
    got = by(portfolio, "loan_id", "risk_category", "maturity_status", "projected_annual_interest_income")
    assert got["1"] == ("Low Risk", "Active", 0) and got["2"][1] == "Near Maturity" and got["3"][1] == "Matured"
    assert got["3"][0] == "Medium Risk"  # 10 is not above 10
    assert got["5"][0] == "Low Risk" and got["6"][0] == "Low Risk"  # unknown borrower
    assert got["4"][2] == D("105.00")
    analysis = loan_plans.loan_portfolio_analysis(portfolio, AS_OF)
    assert analysis.agg(F.sum("loan_count")).first()[0] == 7
    shares = by(analysis, "risk_category", "portfolio_concentration_percentage")
    assert sum(shares.values()) == D("100.00")
    large = loan_plans.loan_portfolio_analysis(portfolio, AS_OF, hot_rows=1)
    key = lambda df: sorted(tuple(r) for r in df.select("loan_count", F.round("median_interest_rate", 6), F.round("p90_loan_amount", 6)).fillna(-1).collect())
    assert key(large) == key(analysis)


@pytest.fixture(scope="module")
def transactions(spark):
    data = [(i, 1, i % 3, 100, f"2024-01-{1 + i // 2:02d} 10:00:00") for i in range(20)]  # two at each time, one spike
    data += [(100, 2, 1, 9000, "2024-01-05 13:30:00"), (101, 3, 2, 5, "2024-02-01"), (102, 4, 1, 7, "2024-02-01"), (103, 4, 1, 7, "2024-02-02 01:59:59")]
    data += [(104, 8, 1, 50, "2024-01-01"), (105, 999, 9, 60, "2024-01-02"), (106, 5, 1, None, "2024-03-01"), (107, 5, 1, 20000, "2024-03-01")]
    return staging.stg_transactions(raw(spark, "transactions", *data)).cache()


@pytest.fixture(scope="module")
def merchants(spark):
    return staging.stg_merchants(raw(spark, "merchants", (0, "Zero", "Oslo"), (1, "One", "Oslo"), (2, "Two", None))).cache()


def test_transaction_enriched(transactions, accounts, customers, merchants):
    enriched = txn_plans.transaction_enriched(transactions, accounts, customers, merchants).cache()
    got = {r.transaction_id: r for r in enriched.collect()}
    assert len(got) == transactions.count()
    spike = got["100"]
    assert spike.customer_id == "0" and spike.transaction_risk_flag == "Anomaly" and spike.value_category == "High Value"
    assert got["107"].value_category == "High Value"
    assert spike.post_transaction_balance == D("50.01") - 9000
    # text ids: 0, 1, 10, 100, ... at their times; the spike follows eight rows of 100 before 13:30 on the fifth, and two that day
    assert spike.cumulative_spend == 10 * 100 + 9000 and spike.rolling_7day_avg == D("1212.500000")
    assert got["101"].transaction_z_score is None and got["101"].transaction_risk_flag == "Normal"  # one transaction
    assert got["102"].transaction_z_score is None and got["103"].hours_since_last_transaction == 25  # equal amounts
    assert got["104"].customer_id is None and got["105"].customer_id is None and got["105"].merchant_name is None
    assert got["105"].cumulative_spend == 110  # transactions without customer form one group
    assert got["106"].amount_usd is None and got["106"].value_category == "Normal"


def test_fact_figures(transactions, accounts, customers, merchants):
    facts = txn_plans.fct_transactions(transactions, accounts, customers, merchants, AS_OF).cache()
    got = {r.transaction_id: r for r in facts.collect()}
    assert (got["0"].total_transactions, got["0"].total_spend, got["0"].median_transaction_amount) == (21, D("11000.00"), 100.0)
    assert got["0"].transactions_per_month is None  # less than a month
    assert got["104"].total_spend is None and got["104"].cumulative_customer_spend == 50 and got["104"].period_customer_key is None
    assert got["107"].high_value_transactions == 1 and got["100"].period_customer_key == "2024~1~0"
    split = txn_plans.fct_transactions(transactions, accounts, customers, merchants, AS_OF, hot_rows=2)
    tidy = lambda df: sorted((tuple(r) for r in df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()), key=repr)
    assert tidy(split) == tidy(facts)

    clv = {r.customer_id: r for r in analytics.clv_analysis(facts, customers, AS_OF).collect()}
    assert clv["0"].estimated_clv == D("3300.00") and clv["0"].clv_tier == "Lowest Value" and clv["0"].customer_lifetime_days == 9
    assert clv["0"].annualized_value == D("446111.11") and clv["1"].annualized_value is None and clv["8"].clv_tier == "Low Value"
    assert analytics.lifetime_value(facts, "0").first().annual_value == pytest.approx(D("446111.11"), abs=D("0.01"))

    patterns = analytics.transaction_patterns(facts)
    assert patterns.agg(F.sum("transaction_count")).first()[0] == 28
    first = patterns.orderBy("transaction_year", "transaction_month", "transaction_dayofweek", "time_of_day").first()
    assert first.trend_direction == "Stable"


def test_account_summary(transactions, accounts, customers):
    summary = account_plans.account_summary(accounts, customers, transactions, AS_OF).cache()
    got = {r.account_id: r for r in summary.collect()}
    assert len(got) == 11
    assert got["1"].activity_level == "Moderate" and got["1"].account_health_status == "Mature Low Activity" and got["1"].turnover_ratio == D("2000.00")
    assert got["4"].account_health_status == "Overdrawn" and got["6"].account_health_status == "Dormant" and got["6"].activity_level == "Inactive"
    assert got["3"].turnover_ratio is None  # balance 0
    assert got["5"].balance_category == "High Balance" and got["9"].balance_category == "Low Balance"
    assert (got["1"].account_age_years, got["1"].account_age_months) == (14, 174)
    split = account_plans.account_summary(accounts, customers, transactions, AS_OF, hot_rows=1)
    assert by(split, "account_id", "median_transaction_amount") == by(summary, "account_id", "median_transaction_amount")


def test_segments(c360):
    dim = customer_plans.dim_customers(c360, AS_OF).cache()
    got = {r.customer_segment: r for r in analytics.segment_analysis(dim).collect()}
    assert sum(r.customer_count for r in got.values()) == 14
    assert sum(r.portfolio_concentration for r in got.values()) == pytest.approx(D(100), abs=D("0.02"))
    assert got["Premium"].health_percentage == 100.0
    split = {r.customer_segment: r for r in analytics.segment_analysis(dim, hot_rows=1).collect()}
    assert split == got


def test_mart_checks(spark, c360, customers, accounts, transactions, merchants):
    marts = {
        "dim_customers": customer_plans.dim_customers(c360, AS_OF),
        "fct_transactions": txn_plans.fct_transactions(transactions, accounts, customers, merchants, AS_OF),
        "fct_account_summary": account_plans.account_summary(accounts, customers, transactions.unionAll(transactions), AS_OF),
    }
    assert {r.status for r in quality.mart_checks(marts).collect()} == {"pass"} and quality.mart_checks(marts).count() == 6
    marts["dim_customers"] = marts["dim_customers"].unionAll(marts["dim_customers"].limit(1))
    failed = quality.mart_checks(marts).filter("status = 'error'").collect()
    assert [(r.table, r.check_name, r.failures) for r in failed] == [("dim_customers", "unique_customer_id", 1)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_batches_equal_a_full_run(spark, transactions, accounts, customers, merchants, hot_rows):
    """Late rows in every batch; the last one amends times and accounts of rows that are stored."""
    names = [f"inc_{kind}_{hot_rows}" for kind in ("enriched", "stats", "accounts", "clv")]
    draw = F.pmod(F.xxhash64("transaction_id"), F.lit(4))
    wrong = transactions.filter(draw == 3)
    wrong = wrong.withColumn("account_id", F.when(F.col("account_id") == "1", "4").otherwise("1")).withColumn("amount_usd", F.col("amount_usd") + 1)
    moved = F.col("transaction_date") - F.expr("INTERVAL 20 DAYS")
    wrong = wrong.withColumn("transaction_date", moved).withColumn("transaction_year", F.year(moved)).withColumn("transaction_month", F.month(moved))
    first = transactions.filter(draw == 0).unionByName(wrong)
    batches = [(first, first), (transactions.filter(draw == 1), first.unionByName(transactions.filter(draw == 1))), (transactions.filter(draw >= 2), transactions)]
    for batch, known in batches:
        replaced = materialise(refresh.replaced_rows(names[0], batch), "replaced")
        stored, stats = refresh.refresh_transactions(names[0], names[1], batch, accounts, customers, merchants, hot_rows)
        summary = refresh.refresh_accounts(names[2], batch, known, accounts, customers, AS_OF, hot_rows, replaced)
        clv = refresh.refresh_clv(names[3], batch, stored, accounts, customers, AS_OF, replaced)
    full = txn_plans.transaction_enriched(transactions, accounts, customers, merchants)
    full_facts = txn_plans.fct_transactions(transactions, accounts, customers, merchants, AS_OF)

    def tidy(df, like):
        return sorted((tuple(r) for r in df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in like.dtypes]).collect()), key=repr)

    assert tidy(refresh.read_enriched(stored, stats), full) == tidy(full, full)
    facts = refresh.read_facts(stored, stats, AS_OF, hot_rows)
    assert sorted(facts.columns) == sorted(full_facts.columns)
    assert tidy(facts, full_facts) == tidy(full_facts, full_facts)
    whole = account_plans.account_summary(accounts, customers, transactions, AS_OF)
    assert tidy(refresh.read_accounts(summary, accounts), whole) == tidy(whole, whole)
    value = analytics.clv_analysis(full_facts, customers, AS_OF).filter("customer_id is not null")
    assert tidy(refresh.read_clv(clv), value) == tidy(value, value)
    for name in [*names, f"{names[1]}_state"]:
        spark.sql(f"DROP TABLE {name}")


def test_a_batch_in_order_leaves_old_partitions_alone(spark, transactions, accounts, customers, merchants):
    go = lambda batch: refresh.refresh_transactions("inc_order", "inc_order_stats", batch, accounts, customers, merchants)
    files = lambda: {r.f for r in spark.table("inc_order").select(F.input_file_name().alias("f")).distinct().collect()}
    march = F.col("transaction_date") >= "2024-03-01"
    go(transactions.filter(~march))
    before = files()
    stored, stats = go(transactions.filter(march))
    assert before <= files() and stored.count() == transactions.count()
    full = txn_plans.transaction_enriched(transactions, accounts, customers, merchants)
    scores = lambda df: sorted((r.transaction_id, r.transaction_risk_flag, r.cumulative_spend) for r in df.collect() if r.cumulative_spend is not None)
    assert scores(refresh.read_enriched(stored, stats)) == scores(full)
    for name in ("inc_order", "inc_order_stats", "inc_order_stats_state"):
        spark.sql(f"DROP TABLE {name}")


def test_state_gives_figures_and_months(spark, transactions, accounts, customers, merchants):
    """Digests give the customer figures; a run that was lost is mended; only the months wanted are read."""
    go = lambda batch, **options: refresh.refresh_transactions("inc_state", "inc_state_stats", batch, accounts, customers, merchants, **options)
    march = F.col("transaction_date") >= "2024-03-01"
    go(transactions.filter(~march))
    spark.sql("ALTER TABLE inc_state_stats_state SET TBLPROPERTIES ('ledgerloom.open' = 'true')")
    gone = sorted(state.partitions_of(spark, "inc_state_stats_state"), key=repr)[:1]
    state.drop_partitions(spark, "inc_state_stats_state", state.PARTITIONS, set(gone))
    stored, stats = go(transactions.filter(march), only_new=True)
    assert not state._left_open(spark, "inc_state_stats_state")
    assert state.partitions_of(spark, "inc_state_stats_state") == state.partitions_of(spark, "inc_state")

    everyone = stored.select("customer_id").distinct()
    want = txn_plans.customer_stats(stored)
    for hot_rows in (None, 2):
        got = state.stats_from_state(stored, "inc_state_stats", everyone, hot_rows)
        assert dict(got.dtypes) == dict(want.dtypes)
        assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))

    # nobody has 30 rows: all months of those who changed; with none wanted before, the months from the change on
    starts = refresh.changed_from(stored.filter(march).select("customer_id", "transaction_date"))
    near = lambda back: materialise(state.reached_months(spark, "inc_state_stats", starts, back), "reached")
    late = {tuple(r) for r in stored.filter(march).select(*state.PARTITIONS).distinct().collect()}
    assert {tuple(r) for r in near(0).select(*state.PARTITIONS).collect()} == late
    assert near(1000).join(everyone, "customer_id").count() >= near(1).count() >= near(0).count() > 0
    rows = refresh.reached_rows(stored, near(0))
    read = {f for f in rows.inputFiles() if "/inc_state/" in f}
    assert read and all(any(f"transaction_year={y}/transaction_month={m}/" in f for y, m in late) for f in read)
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_year", rows._jdf.queryExecution().executedPlan().toString())
    for name in ("inc_state", "inc_state_stats", "inc_state_stats_state"):
        spark.sql(f"DROP TABLE {name}")


def _refreshed_in_three(spark, name, transactions, accounts, customers, merchants):
    """New, amended and moved rows; the last batch puts right what the first had wrong."""
    draw = F.pmod(F.xxhash64("transaction_id"), F.lit(4))
    moved = F.col("transaction_date") - F.expr("INTERVAL 40 DAYS")
    wrong = transactions.filter(draw == 3).withColumn("transaction_date", moved)
    wrong = wrong.withColumn("transaction_year", F.year(moved)).withColumn("transaction_month", F.month(moved))
    for batch in (transactions.filter(draw == 0).unionByName(wrong), transactions.filter(draw == 1), transactions.filter(draw >= 2)):
        stored, stats = refresh.refresh_transactions(name, f"{name}_stats", batch, accounts, customers, merchants)
    return stored, stats


def _rows(df, like):
    return sorted((tuple(r) for r in df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in like.dtypes]).collect()), key=repr)


def test_months_in_pieces_equal_a_full_run(spark, monkeypatch, transactions, accounts, customers, merchants):
    """Two rows are many here: months are written and digested in pieces, customers are looked up after the digest is grouped."""
    monkeypatch.setattr(tables, "PIECE_ROWS", 2)
    monkeypatch.setattr(state, "fitting", lambda df, rows: df)
    stored, stats = _refreshed_in_three(spark, "inc_pieces", transactions, accounts, customers, merchants)
    full = txn_plans.transaction_enriched(transactions, accounts, customers, merchants)
    assert _rows(refresh.read_enriched(stored, stats), full) == _rows(full, full)
    sizes = tables.partition_rows(stored, state.PARTITIONS)
    places = stored.groupBy(tables.place_of(state.PARTITIONS, ["transaction_id"], sizes).alias("place")).count().collect()
    assert len(sizes) < len(places) <= sum(-(-n // 2) for n in sizes.values())
    assert state.partitions_of(spark, "inc_pieces") == {tuple(r) for r in stored.select(*state.PARTITIONS).distinct().collect()}
    for name in ("inc_pieces", "inc_pieces_stats", "inc_pieces_stats_state"):
        spark.sql(f"DROP TABLE {name}")


def test_a_refresh_sends_whole_rows_once(spark, transactions, accounts, customers, merchants):
    """Looking back takes a few columns; whole rows go through one exchange, to where they are written."""
    go = lambda batch: refresh.refresh_transactions("inc_once", "inc_once_stats", batch, accounts, customers, merchants)
    march = F.col("transaction_date") >= "2024-03-01"
    stored, _ = go(transactions.filter(~march))
    fresh = materialise(txn_plans.enriched_rows(transactions.filter(march), accounts, customers, merchants, scores=False), "fresh")
    reached = materialise(state.reached_months(spark, "inc_once_stats", refresh.changed_from(fresh), 30), "reached")
    tails = refresh._tails(stored, fresh, reached)
    assert not {"customer_name", "merchant_name", "transaction_sk", "time_of_day"} & set(tails.columns)

    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        measures = materialise(refresh._look_back(stored, tails, None), "measures")
        sizes = tables.partition_rows(stored, state.PARTITIONS) + tables.partition_rows(fresh, state.PARTITIONS)
        merged = refresh._merged(stored, fresh, measures, stored.limit(0), sizes)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(_place", plan)) == 2 and len(re.findall(r"Exchange", plan.replace("Exchange SinglePartition", ""))) == 2
    assert merged.count() == transactions.count() and merged.dtypes == stored.dtypes
    for name in ("inc_once", "inc_once_stats", "inc_once_stats_state"):
        spark.sql(f"DROP TABLE {name}")


def test_a_batch_may_widen_a_column(spark, transactions, accounts, customers, merchants):
    march = F.col("transaction_date") >= "2024-03-01"
    wide = transactions.withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,2)"))
    for batch in (transactions.filter(~march), wide.filter(march)):
        stored, stats = refresh.refresh_transactions("inc_wide", "inc_wide_stats", batch, accounts, customers, merchants)
    assert dict(stored.dtypes)["amount_usd"] == "decimal(18,2)"
    full = txn_plans.transaction_enriched(wide, accounts, customers, merchants)
    known = refresh.read_enriched(stored, stats)
    pick = ["transaction_id", "transaction_sk", "amount_usd", "rolling_7day_avg", "hours_since_last_transaction", "transaction_risk_flag"]
    assert _rows(known.select(pick), known.select(pick)) == _rows(full.select(pick), known.select(pick))
    for name in ("inc_wide", "inc_wide_stats", "inc_wide_stats_state"):
        spark.sql(f"DROP TABLE {name}")


def test_two_rows_of_a_batch_for_one_transaction_are_refused(spark, transactions, accounts, customers, merchants):
    go = lambda batch: refresh.refresh_transactions("inc_twice", "inc_twice_stats", batch, accounts, customers, merchants)
    stored, _ = go(transactions)
    rows = stored.count()
    with pytest.raises(ValueError, match="several batch rows"):
        go(transactions.unionByName(transactions))
    assert spark.table("inc_twice").count() == rows
    for name in ("inc_twice", "inc_twice_stats", "inc_twice_stats_state"):
        spark.sql(f"DROP TABLE {name}")
