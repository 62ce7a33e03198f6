"""Every registered query: a name and a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.checks import checksums, rows as row_checks, tables as table_checks
from ledgerloom.checks.runner import accepted_range_check, check, not_null_check, row_check, run_checks, unique_check
from ledgerloom.functions import sql as sql_functions
from ledgerloom.functions.expressions import business_key, hash_column, safe_add, safe_divide, safe_subtract
from ledgerloom.operators import generators, keys, projection, proximity, reshape, unions, values, web
from ledgerloom.operators.keyed import keyed_windows
from ledgerloom.operators.ordered import global_rank_ntile
from ledgerloom.operators.percentiles import exact_percentiles
from ledgerloom.plans import accounts, analytics, customers, loans, quality, refresh, staging, state, transactions
from ledgerloom.session import SCRATCH_DATABASE, materialise, scratch_path, scratch_table, tune
from ledgerloom.sources import catalog, marks, registry as sources, rejects, star_schema as star, tables
from ledgerloom.streaming.upserts import stream_upsert

AS_OF = star.AS_OF
EVENTS_AS_OF = "2024-02-01 00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def publish(df: DataFrame) -> DataFrame:
    """Result types that compare across engines: bigint, double and text."""

    def plain(field: T.StructField):
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 4)
        elif isinstance(kind, T.DecimalType):
            c = c.cast("double") if kind.scale <= 6 else F.round(c.cast("double"), 4)
        elif isinstance(kind, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select([plain(field) for field in df.schema.fields])


def query(function: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return publish(function(tune(spark), folder))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


class Bank:
    """The staged tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(star.customers(self.spark, self.folder), AS_OF)

    @cached_property
    def accounts(self) -> DataFrame:
        return staging.stg_accounts(star.accounts(self.spark, self.folder))

    @cached_property
    def cards(self) -> DataFrame:
        return staging.stg_cards(star.cards(self.spark, self.folder), AS_OF)

    @cached_property
    def loans(self) -> DataFrame:
        return staging.stg_loans(star.loans(self.spark, self.folder), AS_OF)

    @cached_property
    def merchants(self) -> DataFrame:
        return staging.stg_merchants(star.merchants(self.spark, self.folder))

    @cached_property
    def branches(self) -> DataFrame:
        return staging.stg_branches(star.branches(self.spark, self.folder))

    @cached_property
    def transactions(self) -> DataFrame:
        return staging.stg_transactions(star.transactions(self.spark, self.folder))

    @cached_property
    def events(self) -> DataFrame:
        return staging.stg_transactions(star.event_transactions(self.spark, self.folder))

    @cached_property
    def size(self) -> int:
        """Transactions: one per order, known from the file footers."""
        return star.read(self.spark, self.folder, "orders").count()

    def c360(self) -> DataFrame:
        return customers.customer_360(self.customers, self.accounts, self.loans, self.cards)

    def dim(self) -> DataFrame:
        return customers.dim_customers(self.c360(), AS_OF)

    def portfolio(self) -> DataFrame:
        return loans.loan_portfolio(self.loans, self.customers, AS_OF)

    def enriched(self) -> DataFrame:
        return transactions.transaction_enriched(self.transactions, self.accounts, self.customers, self.merchants, self.size)

    def facts(self) -> DataFrame:
        return transactions.fct_transactions(self.transactions, self.accounts, self.customers, self.merchants, AS_OF, self.size)

    def summary(self) -> DataFrame:
        return accounts.account_summary(self.accounts, self.customers, self.transactions, AS_OF, self.size)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return star.read(spark, folder, name)


# ---------------------------------------------------------------- staging


@query
def stg_accounts(spark, folder):
    return Bank(spark, folder).accounts


@query
def stg_branches(spark, folder):
    return Bank(spark, folder).branches


@query
def stg_cards(spark, folder):
    return Bank(spark, folder).cards


@query
def stg_customers(spark, folder):
    return Bank(spark, folder).customers


@query
def stg_loans(spark, folder):
    return Bank(spark, folder).loans


@query
def stg_merchants(spark, folder):
    return Bank(spark, folder).merchants


@query
def stg_transactions(spark, folder):
    return Bank(spark, folder).transactions


@query
def stg_event_transactions(spark, folder):
    """Staging over rows that have a time of day."""
    return Bank(spark, folder).events


# -------------------------------------------------------------- pipelines


@query
def customer_360(spark, folder):
    return Bank(spark, folder).c360()


@query
def customer_card_info(spark, folder):
    bank = Bank(spark, folder)
    return customers.customer_card_info(bank.customers, bank.accounts, bank.cards, AS_OF)


@query
def dim_customers(spark, folder):
    return Bank(spark, folder).dim()


@query
def loan_portfolio(spark, folder):
    return Bank(spark, folder).portfolio()


@query
def loan_portfolio_analysis(spark, folder):
    bank = Bank(spark, folder)
    return loans.loan_portfolio_analysis(bank.portfolio(), AS_OF, bank.loans)


@query
def transaction_enriched(spark, folder):
    return Bank(spark, folder).enriched()


@query
def fct_transactions(spark, folder):
    return Bank(spark, folder).facts()


@query
def fct_account_summary(spark, folder):
    return Bank(spark, folder).summary()


@query
def clv_analysis(spark, folder):
    bank = Bank(spark, folder)
    # lifetime value needs five columns of the fact table and none of its windows
    return analytics.clv_analysis(transactions.with_customer(bank.transactions, bank.accounts), bank.customers, AS_OF)


@query
def calculate_clv(spark, folder):
    return analytics.lifetime_value(transactions.with_customer(*_txn(spark, folder)))


def _txn(spark, folder):
    bank = Bank(spark, folder)
    return bank.transactions, bank.accounts


@query
def segment_analysis(spark, folder):
    bank = Bank(spark, folder)
    return analytics.segment_analysis(bank.dim(), bank.customers)


@query
def transaction_patterns(spark, folder):
    bank = Bank(spark, folder)
    return analytics.transaction_patterns(bank.enriched(), bank.transactions, bank.size)


@query
def event_patterns(spark, folder):
    """Spending patterns of transactions with a time of day."""
    rows = Bank(spark, folder).events.withColumn("customer_id", F.col("account_id"))
    return analytics.transaction_patterns(transactions.rolling_measures(rows, at_most=rows), rows)


@query
def mart_checks(spark, folder):
    bank = Bank(spark, folder)
    # as tables, the way the checks meet them; several checks read each
    marts = {"dim_customers": bank.dim(), "fct_transactions": bank.facts(), "fct_account_summary": bank.summary()}
    return quality.mart_checks({name: materialise(df.select(quality.KEYS[name]), name) for name, df in marts.items()})


# ---------------------------------------------------------------- windows


@query
def txn_rolling_measures(spark, folder):
    """Rolling means, running spend, gaps, z-scores and flags per user."""
    rows = Bank(spark, folder).events.withColumn("customer_id", F.col("account_id"))
    return transactions.rolling_measures(rows, at_most=rows).select(
        "transaction_id", "customer_id", "rolling_7day_avg", "rolling_30day_avg", "cumulative_spend",
        "transaction_z_score", "transaction_risk_flag", "hours_since_last_transaction",
    )


@query
def txn_rolling_measures_split(spark, folder):
    """The same with every user above 60 events cut into blocks."""
    rows = Bank(spark, folder).events.withColumn("customer_id", F.col("account_id"))
    return transactions.rolling_measures(rows, hot_rows=60, partitions=7).select(
        "transaction_id", "customer_id", "rolling_7day_avg", "rolling_30day_avg", "cumulative_spend",
        "transaction_z_score", "transaction_risk_flag", "hours_since_last_transaction",
    )


@query
def txn_percentile_bands(spark, folder):
    txn = Bank(spark, folder).transactions.select("transaction_id", "amount_usd")
    return transactions.with_marks(txn, transactions.amount_marks(txn, Bank(spark, folder).size))


@query
def customer_wealth_rank_ntile(spark, folder):
    totals = customers.account_totals(Bank(spark, folder).accounts).select("customer_id", "total_balance_usd")
    return global_rank_ntile(totals, "total_balance_usd", "customer_id", 5, "balance_rank", "wealth_quintile")


@query
def order_priority_rank_ntile(spark, folder):
    """Rank with huge ties: all orders by priority, in seven tiles."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return global_rank_ntile(orders, "o_orderpriority", "o_orderkey", 7, "priority_rank", "priority_tile", partitions=6)


@query
def segment_price_percentiles(spark, folder):
    return exact_percentiles(
        table(spark, folder, "orders"), ["o_orderpriority"], {"median_price": ("o_totalprice", 0.5), "p90_price": ("o_totalprice", 0.9)}
    )


@query
def flag_price_percentiles_split(spark, folder):
    """Percentiles of groups that each hold a third of all rows, by radix selection."""
    lines = table(spark, folder, "lineitem")
    points = {"median_price": ("l_extendedprice", 0.5), "p99_price": ("l_extendedprice", 0.99), "median_qty": ("l_quantity", 0.5)}
    return exact_percentiles(lines, ["l_returnflag"], points, hot_rows=1000)


@query
def flag_quantity_percentiles_counted(spark, folder):
    """Percentiles from counted values instead of rows, of groups that each hold a third of all rows."""
    counted = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_quantity", "l_discount").agg(F.count(F.lit(1)).alias("times"))
    points = {"p10_qty": ("l_quantity", 0.1), "median_qty": ("l_quantity", 0.5), "p99_discount": ("l_discount", 0.99)}
    large = exact_percentiles(counted, ["l_returnflag"], points, hot_rows=100, weight="times")
    return large.withColumn("form", F.lit("narrowed")).unionByName(
        exact_percentiles(counted, ["l_returnflag"], points, weight="times").withColumn("form", F.lit("built in"))
    )


@query
def order_running_total(spark, folder):
    """Running total over the whole table in date order, with no single-task window."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    by_date = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    return keyed_windows(orders, [], by_date, running={"running_cents": "cents"}, hot_rows=4000, partitions=5)


# ----------------------------------------------------------- table operators


@query
def star_projection(spark, folder):
    return projection.star(table(spark, folder, "customer"), exclude=["C_ACCTBAL"], prefix="x_", suffix="_y")


@query
def staging_columns(spark, folder):
    return projection.staging_columns(table(spark, folder, "supplier"), exclude=["s_acctbal", "S_NAME"])


@query
def nullcheck(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("flag"), "l_linestatus"
    )
    return projection.nullcheck(lines).groupBy("flag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query
def group_by_first_columns(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return projection.group_by_first(lines, 2).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query
def mask_customers(spark, folder):
    people = star.customers(spark, folder).select("customer_id", "email", "first_name")
    return projection.mask_columns(people, ["email", "first_name"])


@query
def surrogate_keys(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.nullif("l_returnflag", F.lit("N")).alias("flag")
    )
    return keys.with_surrogate_key(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flag"], "line_sk")


@query
def surrogate_key_report(spark, folder):
    return keys.key_report(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def business_keys(spark, folder):
    orders = table(spark, folder, "orders")
    flag = F.nullif("o_orderstatus", F.lit("P"))
    return orders.select("o_orderkey", business_key(["o_custkey", flag, "o_orderpriority"]).alias("order_key"), hash_column("o_custkey").alias("customer_hash"))


@query
def dedupe_latest_order(spark, folder):
    return reshape.deduplicate(table(spark, folder, "orders"), ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "desc")])


@query
def dedupe_first_event(spark, folder):
    """Mixed directions: largest value first, then the earliest."""
    return reshape.deduplicate(table(spark, folder, "events"), ["user_id", "event_type"], [("value", "desc"), ("event_id", "asc")])


@query
def dedupe_mixed_text(spark, folder):
    """Mixed directions on text: the last status and priority by name, then the earliest order."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"), "o_orderpriority")
    return reshape.deduplicate(orders, ["o_custkey"], [("s", "desc"), ("o_orderpriority", "desc"), ("o_orderkey", "asc")])


@query
def pivot_priority_counts(spark, folder):
    orders = table(spark, folder, "orders")
    found = values.column_values(spark, orders, "o_orderpriority", refuse_above=50)
    return reshape.pivot(orders, ["o_orderstatus"], "o_orderpriority", sorted(found), prefix="n ", slug=True)


@query
def pivot_quantity_sums(spark, folder):
    lines = table(spark, folder, "lineitem")
    return reshape.pivot(lines, ["l_linestatus"], "l_returnflag", ["A", "N", "R"], then_value="l_quantity", suffix="_qty")


@query
def unpivot_lineitem_measures(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_tax")
    return reshape.unpivot(lines, "string", ["l_orderkey", "l_linenumber"], ["l_tax"], "prop", "val")


@query
def union_relations_people(spark, folder):
    parts = {
        "customer": table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        "supplier": table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")),
    }
    return unions.union_relations(parts, column_override={"nation": "string"}, where="name not like '%7'")


@query
def union_relations_exclude(spark, folder):
    parts = {
        "orders": table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), "o_custkey"),
        "lineitem": table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("status"), "l_suppkey"),
    }
    return unions.union_relations(parts, exclude=["L_SUPPKEY"], source_column_name=None)


@query
def relations_by_prefix_union(spark, folder):
    """Event tables by type, found by their name prefix and put together again."""
    prefix = scratch_table(spark, "ev").split(".")[1]
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    for kind in values.column_values(spark, events, "event_type", refuse_above=50):
        events.filter(F.col("event_type") == kind).write.mode("overwrite").saveAsTable(f"{SCRATCH_DATABASE}.{prefix}_{kind}")
    found = catalog.relations_by_prefix(spark, SCRATCH_DATABASE, f"{prefix}_", exclude=f"{prefix}_error")
    return unions.union_relations(catalog.open_relations(found), source_column_name=None)


@query
def series_orders_without_lines(spark, folder):
    """Numbers up to the largest order key that no line refers to."""
    top = table(spark, folder, "orders").agg(F.max("o_orderkey").alias("top")).first()["top"]
    delivered = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("generated_number"))
    return generators.generate_series(spark, top).join(delivered, "generated_number", "left_anti")


@query
def date_spine_daily_orders(spark, folder):
    """Orders per day and status over ten years, days without orders as 0."""
    orders = table(spark, folder, "orders")
    measures = {"n_orders": F.count(F.lit(1)), "n_customers": F.count_distinct("o_custkey")}
    return generators.fill_periods(orders, "day", "o_orderdate", "1994-12-25", "2002-01-10", measures, ["o_orderstatus"], "order_day")


@query
def date_spine_hourly_events(spark, folder):
    return generators.fill_periods(
        table(spark, folder, "events"), "hour", "ts", "2024-01-01", "2024-02-01", {"n_events": F.count(F.lit(1))}, period="event_hour"
    )


@query
def date_spine_monthly_orders(spark, folder):
    return generators.fill_periods(
        table(spark, folder, "orders"), "month", "o_orderdate", "1995-01-01", "2003-01-01", {"n_orders": F.count(F.lit(1))}, period="order_month"
    )


def _orders_per(part: str, start: str, end: str):
    def run(spark, folder):
        rows = table(spark, folder, "orders")
        return generators.fill_periods(rows, part, "o_orderdate", start, end, {"n_orders": F.count(F.lit(1))}, ["o_orderstatus"], period="starts_on")

    run.__name__, run.__doc__ = f"date_spine_orders_per_{part}", f"Orders per {part} and status, periods without orders as 0."
    return run


for _part, _start in (("week", "1994-12-26"), ("quarter", "1995-01-01"), ("year", "1994-01-01")):
    query(_orders_per(_part, _start, "2003-01-01"))


@query
def date_spine_minutely_events(spark, folder):
    """Events per minute of a month and type: a long spine for every key."""
    return generators.fill_periods(
        table(spark, folder, "events"), "minute", "ts", "2024-01-01", "2024-02-01", {"n_events": F.count(F.lit(1))}, ["event_type"], period="minute"
    )


@query
def column_value_freq(spark, folder):
    return values.value_frequencies(table(spark, folder, "lineitem"), "l_suppkey", max_records=25, where="l_quantity > 10")


@query
def pivot_top_suppliers(spark, folder):
    """A pivot over the five suppliers that come first by their total, taken as a list."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_suppkey")
    top = values.column_values(spark, lines, "l_suppkey", max_records=5, order_by=[F.desc("n"), F.desc("value")])
    long = lines.filter(F.col("l_suppkey").isin(top)).groupBy("l_returnflag", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    wide = reshape.pivot(lines, ["l_returnflag"], "l_suppkey", top, prefix="s_")
    return reshape.unpivot(wide, "bigint", ["l_returnflag"], field_name="supplier", value_name="n").filter("n > 0").join(
        long.select("l_returnflag", F.concat(F.lit("s_"), "l_suppkey").alias("supplier"), "n"), ["l_returnflag", "supplier", "n"]
    )


@query
def single_value(spark, folder):
    newest = table(spark, folder, "orders").agg(F.max("o_totalprice").alias("m"))
    none = table(spark, folder, "orders").filter("o_totalprice < 0").select("o_totalprice")
    return values.single_value(newest, name="largest").crossJoin(F.broadcast(values.single_value(none, -1.0, name="absent")))


@query
def share_of_total(spark, folder):
    """Each order's share of all revenue, in parts per million."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    whole = F.broadcast(orders.agg(F.sum("cents").alias("_whole")))
    return orders.crossJoin(whole).select("o_orderkey", (F.try_divide("cents", "_whole") * 1000000).alias("share_ppm"))


@query
def price_histogram(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    return values.histogram(lines, "l_extendedprice", 10000.0, 90000.0, 16, total="cents")


@query
def net_totals(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_suppkey", "l_linenumber", F.nullif(F.col("l_quantity").cast("bigint"), F.lit(7).cast("bigint")).alias("qty")
    )
    return values.net_totals(lines, ["l_returnflag"], ["qty", "l_linenumber", "l_suppkey"])


@query
def safe_arithmetic(spark, folder):
    lines = table(spark, folder, "lineitem")
    qty = F.nullif(F.col("l_quantity").cast("bigint"), F.lit(5).cast("bigint"))
    number = F.nullif("l_linenumber", F.lit(2))
    rows = lines.select("l_orderkey", "l_linenumber", "l_suppkey", qty.alias("q"), number.alias("n"))
    return rows.groupBy("l_linenumber").agg(
        F.sum(safe_add(["q", "n", "l_suppkey"])).alias("added"),
        F.sum(safe_subtract(["q", "n", "l_suppkey"])).alias("subtracted"),
        F.count(safe_divide("q", F.col("l_suppkey") % 10)).alias("divided"),
        F.sum(safe_divide("q", F.col("l_suppkey") % 10)).alias("quotients"),
    )


@query
def url_host_counts(spark, folder):
    return web.host_counts(table(spark, folder, "pages"))


@query
def url_path_counts(spark, folder):
    return web.path_counts(table(spark, folder, "pages"))


@query
def url_top_paths(spark, folder):
    return web.top_paths(table(spark, folder, "pages"), 2)


@query
def url_param_counts(spark, folder):
    return web.parameter_counts(table(spark, folder, "pages"), "utm_source")


def _points(spark, folder, name, key, label):
    """Points spread over the globe by fixed arithmetic on the key."""
    k = F.col(key)
    return table(spark, folder, name).select(
        k.alias(label), (((k * 7919) % 17900) / 100.0 - 89.5).alias("lat"), (((k * 104729) % 36000) / 100.0 - 180.0).alias("lon")
    )


@query
def proximity_pairs(spark, folder):
    """Customers and suppliers within 300 km of each other."""
    people = _points(spark, folder, "customer", "c_custkey", "left_id")
    shops = _points(spark, folder, "supplier", "s_suppkey", "right_id")
    return proximity.proximity_pairs(people, shops, 300.0, "km")


@query
def proximity_same_place(spark, folder):
    """Customers and suppliers on the very same point."""
    place = lambda key: (F.pmod(key, F.lit(97)) * 1.5 - 70, F.pmod(key, F.lit(97)) * 3.25 - 160)
    sides = []
    for name, key, label in (("customer", "c_custkey", "left_id"), ("supplier", "s_suppkey", "right_id")):
        lat, lon = place(F.col(key))
        sides.append(table(spark, folder, name).select(F.col(key).alias(label), lat.alias("lat"), lon.alias("lon")))
    return proximity.proximity_pairs(*sides, 0.0, "km")


# ------------------------------------------------------- forms of any size


def _agreement(forms: dict[str, DataFrame]) -> DataFrame:
    """Rows of each form, and rows that differ from the first one in any column, unrounded."""
    # by checksums first, so that rows are exchanged only where forms differ; those of each form are counted per distinct row
    names = list(forms)
    n_rows, near = checksums.differing_forms(list(forms.values()))
    held = [df.select("*", *[F.lit(int(n == name)).cast("bigint").alias(f"_in_{k}") for k, n in enumerate(names)]) for name, df in zip(names, near)]
    columns = [F.col(f"`{c}`") for c in forms[names[0]].columns]
    counted = reduce(DataFrame.unionAll, held).groupBy(*columns).agg(*[F.sum(f"_in_{k}").alias(f"_n_{k}") for k in range(len(names))])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    rows = lambda k: total(F.col(f"_n_{k}")) if n_rows is None else F.lit(n_rows[k]).cast("bigint")
    sums = [F.struct(F.lit(n).alias("form"), rows(k).alias("n_rows"), total(F.abs(F.col(f"_n_{k}") - F.col("_n_0"))).alias("n_differing")) for k, n in enumerate(names)]
    return counted.agg(F.array(*sums).alias("forms")).select(F.inline("forms"))


THRESHOLDS = {"above": 10**9, "middle": 60, "one": 1}


@query
def forms_of_windows(spark, folder):
    """Rolling and running measures, deviations and percentiles, whatever size a key is cut at."""
    rows = Bank(spark, folder).events.withColumn("customer_id", F.col("account_id"))
    return _agreement({n: transactions.rolling_measures(rows, figures=True, hot_rows=t, partitions=7) for n, t in THRESHOLDS.items()})


@query
def order_price_percentiles_narrowed(spark, folder):
    """Percentiles of the whole table, and of each status, by radix selection."""
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_totalprice")
    points = {"least_price": ("o_totalprice", 0.0), "p01_price": ("o_totalprice", 0.01), "median_price": ("o_totalprice", 0.5), "top_price": ("o_totalprice", 1.0)}
    whole = exact_percentiles(orders, [], points, hot_rows=0).select(F.lit("all").alias("o_orderstatus"), *points)
    return whole.unionByName(exact_percentiles(orders, ["o_orderstatus"], points, hot_rows=0))


@query
def latest_event_of_user(spark, folder):
    """Deduplication by mixed directions over doubles that hold NaN and longs that hold the smallest one."""
    rows = table(spark, folder, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("value")).alias("worth"))
    rows = rows.withColumn("code", F.when(F.col("event_id") % 5 == 0, F.lit(-(2**63))).otherwise(F.col("event_id")))
    found = reshape.deduplicate(rows, ["user_id"], [("worth", "desc"), ("event_id", "asc")]).select("user_id", "event_id")
    least = reshape.deduplicate(rows, ["user_id"], [("user_id", "asc"), ("code", "desc"), ("event_id", "asc")]).select("user_id", F.col("event_id").alias("by_code"))
    return found.join(least, "user_id")


@query
def forms_of_percentiles(spark, folder):
    """Percentiles per key, whatever size a group is cut at."""
    lines = table(spark, folder, "lineitem")
    points = {"median_price": ("l_extendedprice", 0.5), "p99_qty": ("l_quantity", 0.99)}
    return _agreement({n: exact_percentiles(lines, ["l_suppkey"], points, hot_rows=t) for n, t in THRESHOLDS.items()})


@query
def forms_of_ranges(spark, folder):
    """Overlapping ranges, whatever size a key is cut at."""
    spans = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("lo"), F.date_add("o_orderdate", 200).alias("hi"))
    find = lambda t: table_checks.mutually_exclusive_ranges(spans, "lo", "hi", "o_custkey", gaps="required", hot_rows=t)
    return _agreement({n: find(t) for n, t in {**THRESHOLDS, "middle": 12}.items()})


@query
def forms_of_sequences(spark, folder):
    """Gaps in a sequence, whatever size a key is cut at."""
    # evaluated once: each form reads it several times
    rows = materialise(table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey").distinct(), "pairs")
    find = lambda t: table_checks.sequential_values(rows, "l_orderkey", group_by=["l_suppkey"], hot_rows=t)
    return _agreement({n: find(t) for n, t in THRESHOLDS.items()})


@query
def forms_of_proximity(spark, folder):
    """Pairs within a radius, whatever size a cell is cut at."""
    people = _points(spark, folder, "customer", "c_custkey", "left_id")
    shops = _points(spark, folder, "supplier", "s_suppkey", "right_id")
    return _agreement({n: proximity.proximity_pairs(people, shops, 700.0, "km", hot_rows=t) for n, t in {**THRESHOLDS, "middle": 9}.items()})


# --------------------------------------------------------- tables and upserts


@query
def csv_rejects_of_orders(spark, folder):
    """Orders as CSV, of which some have no number for the price and some miss a field: rows taken and records rejected."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(cents)
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), price)
    line = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(line, F.lit(","), "o_orderpriority")).otherwise(line)
    path = scratch_path(spark, "lines")
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_custkey BIGINT, cents BIGINT, o_orderpriority STRING")
    accepted, rejected = rejects.read_csv_checked(spark, path, schema, {"header": "false"})
    return accepted.unionByName(rejected.select(F.col(rejects.RECORD).alias("record")), allowMissingColumns=True)


@query
def sql_text_functions(spark, folder):
    """SQL text with the library's functions: months of a spine, masked customers, guarded means."""
    sql_functions.register(spark)
    table(spark, folder, "orders").createOrReplaceTempView("_sql_orders")
    table(spark, folder, "customer").createOrReplaceTempView("_sql_customer")
    return spark.sql("""
        SELECT m.date_month, business_key(array(c.c_mktsegment, o.o_orderpriority)) AS business_key, min(mask_pii(c.c_name)) AS masked, count(o.o_orderkey) AS n_orders,
               floor(safe_divide(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)), count(o.o_orderkey))) AS mean_cents, min(surrogate_key(array(c.c_mktsegment, o.o_orderpriority))) AS first_key
        FROM date_spine_month(TIMESTAMP '1994-01-01', TIMESTAMP '2003-01-01') m
        LEFT JOIN _sql_orders o ON date_trunc('month', o.o_orderdate) = m.date_month LEFT JOIN _sql_customer c ON c.c_custkey = o.o_custkey
        GROUP BY ALL""")


def _csv_load(source: str, stage: Callable[[DataFrame], DataFrame]):
    def run(spark, folder):
        root = scratch_path(spark, "csv")
        getattr(star, source)(spark, folder).write.option("header", True).csv(f"{root}/{source}")
        name = scratch_table(spark, source)
        return stage(sources.create_table_from_csv(spark, name, f"{root}/{source}", sources.SCHEMAS[source]))

    run.__name__, run.__doc__ = f"csv_load_{source}", f"The {source} written as CSV, loaded into a table as text and staged."
    return run


for _source, _stage in {
    "customers": lambda df: staging.stg_customers(df, AS_OF),
    "accounts": staging.stg_accounts,
    "branches": staging.stg_branches,
    "cards": lambda df: staging.stg_cards(df, AS_OF),
    "loans": lambda df: staging.stg_loans(df, AS_OF),
    "merchants": staging.stg_merchants,
    "transactions": staging.stg_transactions,
}.items():
    query(_csv_load(_source, _stage))


@query
def view_of_orders(spark, folder):
    """Totals read through a named view."""
    tables.create_view(table(spark, folder, "orders").filter("o_orderstatus <> 'P'"), "settled_orders")
    return spark.sql("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM settled_orders GROUP BY ALL")


@query
def relation_types(spark, folder):
    """Kinds of catalog entries by their names: managed tables, one with files of its own place, and a view."""
    prefix = scratch_table(spark, "kinds").split(".")[1]
    events = table(spark, folder, "events")
    found_types = sorted(values.column_values(spark, events, "event_type", refuse_above=50))
    for k, kind in enumerate(found_types):
        name, rows = f"{SCRATCH_DATABASE}.{prefix}_{kind}", events.filter(F.col("event_type") == kind)
        rows.write.options(**({"path": scratch_path(spark, "external")} if k == 0 else {})).saveAsTable(name)
    spark.sql(f"CREATE VIEW {SCRATCH_DATABASE}.{prefix}_shown AS SELECT * FROM {SCRATCH_DATABASE}.{prefix}_{found_types[0]}")
    found = catalog.relations_by_prefix(spark, SCRATCH_DATABASE, f"{prefix}_")
    return found.select(F.replace("table_name", F.lit(f"{prefix}_"), F.lit("")).alias("name"), "table_type")


@query
def order_inside_files(spark, folder):
    """Rows of a partitioned table that stand before a smaller one of the same file, per partition."""
    name = scratch_table(spark, "clustered")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.write_partitioned(orders, name, ["o_orderstatus"], ["o_custkey", "o_orderkey"])
    placed = spark.table(name).withColumn("_file", F.xxhash64(F.input_file_name())).withColumn("_at", F.monotonically_increasing_id())
    return _late_rows(placed, ["o_custkey", "o_orderkey"], "o_orderstatus")


ROWS_IN_PIECE = 1 << 16  # divides the row numbers of a partition, so that no piece spans two


def _late_rows(placed: DataFrame, order: list[str], key: str) -> DataFrame:
    """Per ``key``, the rows and those that stand before a smaller one of the same ``_file`` by their place ``_at``.

    Places are compared inside pieces of a file; then the last row of a piece with the first one of the next.
    """
    own, piece = F.struct(*order), [key, "_file", "_piece"]
    cut = placed.select(key, *order, "_file", "_at", F.floor(F.col("_at") / ROWS_IN_PIECE).alias("_piece"))
    following = cut.withColumn("_next", F.lead(own).over(Window.partitionBy(*piece).orderBy("_at")))
    pieces = following.groupBy(*piece).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_next") < own).alias("_late"), F.min_by(own, "_at").alias("_first"), F.max_by(own, "_at").alias("_last")
    )
    meeting = F.lead("_first").over(Window.partitionBy(key, "_file").orderBy("_piece")) < F.col("_last")
    joined = pieces.withColumn("_meets_late", F.coalesce(meeting, F.lit(False)).cast("bigint"))
    return joined.groupBy(key).agg(F.sum("_n").alias("n"), F.sum(F.col("_late") + F.col("_meets_late")).alias("n_out_of_order"))


@query
def partitioned_table_by_month(spark, folder):
    """Orders in a table by year and month, created once; the months of 1995 replaced later."""
    name = scratch_table(spark, "orders_by_month")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    sources.create_partitioned_if_absent(orders, name, "o_orderdate", ("year", "month"))
    sources.create_partitioned_if_absent(orders.limit(0), name, "o_orderdate", ("year", "month"))  # exists: nothing happens
    changed = sources.with_date_parts(orders.filter("year(o_orderdate) = 1995").withColumn("o_orderstatus", F.lit("X")), "o_orderdate")
    sources.insert_overwrite(changed, name)
    return spark.table(name).groupBy("year", "month", "day", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query
def rebuild_table_in_place(spark, folder):
    """A table rebuilt from itself."""
    name = scratch_table(spark, "rebuild")
    tables.write_table(table(spark, folder, "supplier"), name)
    return tables.write_table(spark.table(name).withColumn("s_acctbal", F.col("s_acctbal") * 2), name)


@query
def upsert_orders(spark, folder):
    """Open orders first, then a batch that closes some and adds the rest."""
    name = scratch_table(spark, "upsert")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    )
    tables.upsert(orders.filter("o_orderstatus <> 'F'"), name, "o_orderkey", ["y", "m"], ["o_custkey"])
    batch = orders.filter("o_orderstatus <> 'P'").withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("2")))
    return tables.upsert(batch, name, "o_orderkey", ["y", "m"], ["o_custkey"])


@query
def upsert_moved_rows(spark, folder):
    """Rows whose partition changes leave the old one; a table bucketed by key."""
    name, other = scratch_table(spark, "moved"), scratch_table(spark, "bucketed")
    people = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    tables.upsert(people, name, "c_custkey", ["c_mktsegment"])
    moved = people.filter("c_mktsegment = 'MACHINERY'").withColumn("c_mktsegment", F.lit("TOOLS"))
    renamed = tables.upsert(moved, name, "c_custkey", ["c_mktsegment"])
    tables.upsert(renamed, other, "c_custkey", buckets=8)
    return tables.upsert(renamed.filter("c_mktsegment = 'TOOLS'").withColumn("vip", F.lit(1)), other, "c_custkey", buckets=8)


@query
def upsert_sync_columns(spark, folder):
    """A batch without one column and with a new one, columns kept in step."""
    name = scratch_table(spark, "sync")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size")
    tables.upsert(parts, name, "p_partkey", buckets=4)
    batch = parts.filter("p_size > 25").select("p_partkey", "p_size", F.lit("big").alias("label"))
    return tables.upsert(batch, name, "p_partkey", buckets=4, on_schema_change="sync_all_columns")


@query
def upsert_null_keys(spark, folder):
    """A batch with a missing key, given twice: it matches itself."""
    name = scratch_table(spark, "null_keys")
    key = F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority")
    batch = table(spark, folder, "orders").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    tables.upsert(batch.withColumn("n", F.col("n") - 1), name, "priority", buckets=3)
    tables.upsert(batch, name, "priority")
    return tables.upsert(batch, name, "priority")


@query
def upsert_other_bucket_count(spark, folder):
    """Another bucket count than the table's is refused and changes nothing."""
    name = scratch_table(spark, "bucket_count")
    people = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    tables.upsert(people, name, "c_custkey", buckets=8)
    try:
        tables.upsert(people.withColumn("c_mktsegment", F.lit("X")), name, "c_custkey", buckets=64)
        refused = False
    except ValueError:
        refused = True
    return tables.upsert(people.filter("c_custkey % 2 = 0"), name, "c_custkey").withColumn("refused", F.lit(refused))


@query
def upsert_added_column(spark, folder):
    """A batch with a new column: files of the partitions it does not touch stay as they are."""
    name = scratch_table(spark, "added")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.upsert(orders, name, "o_orderkey", ["o_orderstatus"])
    files = lambda: spark.table(name).select("o_orderstatus", F.input_file_name().alias("file")).distinct()
    before = materialise(files(), "files")
    batch = orders.filter("o_orderstatus = 'P'").withColumn("label", F.lit("pending"))
    result = tables.upsert(batch, name, "o_orderkey", ["o_orderstatus"])
    kept = materialise(files(), "files").join(before, ["o_orderstatus", "file"]).select("o_orderstatus").distinct().withColumn("untouched", F.lit(True))
    return result.join(kept, "o_orderstatus", "left").withColumn("untouched", F.coalesce("untouched", F.lit(False)))


@query
def newer_than_mark(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return tables.newer_than_mark(orders, orders.filter("o_orderdate < '2000-01-01'"), "o_orderdate")


@query
def unread_files_of_orders(spark, folder):
    """Orders that arrive in three drops, the oldest last, taken file by file: none is passed over."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    root, name, target = scratch_path(spark, "drops"), scratch_table(spark, "marks"), scratch_path(spark, "taken")
    for drop in ("o_orderdate >= '1999-01-01'", "o_orderdate >= '1997-01-01' AND o_orderdate < '1999-01-01'", "o_orderdate < '1997-01-01'"):
        orders.filter(drop).write.mode("append").parquet(root)
        rows, files = marks.read_unread(spark, root, name, orders.schema)
        rows.write.mode("append").parquet(target)
        marks.mark_read(files, name)
    return spark.read.schema(orders.schema).parquet(target)


@query
def incremental_affected_customers(spark, folder):
    """All orders of the customers that ordered since 2001-07-01."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return tables.rows_of_affected(orders, orders.filter("o_orderdate >= '2001-07-01'"), "o_custkey")


def _batches(bank: Bank):
    """Three batches and the transactions known after each: in order, late ones of a merchant, and amended ones.

    The first two hold a ninth of the transactions with another time or account, which the third puts right.
    """
    raw = materialise(star.transactions(bank.spark, bank.folder), "raw")
    key = F.col("transaction_id")
    moved = F.when(key % 18 == 0, F.date_add("transaction_date", (key % 80 - 40).cast("int")).cast("timestamp")).otherwise(F.col("transaction_date"))
    owner = F.when(key % 18 == 9, key % 50 * 2 + 1).otherwise(F.col("account_id"))
    first = staging.stg_transactions(raw.withColumn("transaction_date", moved).withColumn("account_id", owner))
    late = (F.col("transaction_date") >= "2001-06-01") | F.coalesce(F.col("merchant_id") == 3, F.lit(False))
    final = staging.stg_transactions(raw)
    yield first.filter(~late), first.filter(~late)
    yield first.filter(late), first
    yield final.filter(key % 9 == 0), final


@query
def refresh_in_batches(spark, folder):
    """Fact table kept up by three batches, with late, amended and re-owned rows."""
    bank = Bank(spark, folder)
    name, stats_name = scratch_table(spark, "enriched"), scratch_table(spark, "stats")
    for batch, _ in _batches(bank):
        stored, stats = refresh.refresh_transactions(name, stats_name, batch, bank.accounts, bank.customers, bank.merchants)
    return refresh.read_facts(stored, stats, AS_OF)


@query
def customer_figures_in_batches(spark, folder):
    """Totals and percentiles per customer from the monthly digest that three batches keep up."""
    bank = Bank(spark, folder)
    name, stats_name = scratch_table(spark, "enriched"), scratch_table(spark, "stats")
    for batch, _ in _batches(bank):
        stored, _ = refresh.refresh_transactions(name, stats_name, batch, bank.accounts, bank.customers, bank.merchants)
    known = state.stats_from_state(stored, stats_name).filter("customer_id IS NOT NULL")
    return known.select("customer_id", "total_transactions", "total_spend", "high_value_transactions", *transactions.CUSTOMER_POINTS)


def _replaced(before: DataFrame | None, batch: DataFrame) -> DataFrame | None:
    """What was known before of the batch's transactions."""
    return None if before is None else before.join(batch.select("transaction_id"), "transaction_id", "left_semi")


@query
def refresh_accounts_in_batches(spark, folder):
    """Account summary kept up by three batches, with late, amended and re-owned rows."""
    bank = Bank(spark, folder)
    name, before = scratch_table(spark, "summary"), None
    for batch, known in _batches(bank):
        stored = refresh.refresh_accounts(name, batch, known, bank.accounts, bank.customers, AS_OF, replaced=_replaced(before, batch))
        before = known
    return refresh.read_accounts(stored, bank.accounts)


@query
def refresh_clv_in_batches(spark, folder):
    """Lifetime value kept up by three batches, with late, amended and re-owned rows."""
    bank = Bank(spark, folder)
    name, before = scratch_table(spark, "clv"), None
    for batch, known in _batches(bank):
        facts = transactions.with_customer(known, bank.accounts)
        stored = refresh.refresh_clv(name, batch, facts, bank.accounts, bank.customers, AS_OF, _replaced(before, batch))
        before = facts
    return refresh.read_clv(stored)


@query
def stream_upsert_orders(spark, folder):
    """Orders arriving as three files in two orders, each replayed at the end: the latest order of a customer wins."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    results = []
    for k, arrivals in enumerate(((0, 1, 2), (2, 0, 1))):
        name, source = scratch_table(spark, "streamed"), scratch_path(spark, "arrivals")
        for file in arrivals:
            orders.filter(part == file).write.mode("append").parquet(source)
            stream_upsert(spark, source, orders.schema, name, "o_custkey", "o_orderkey", f"{source}-checkpoint")
        # all files again, as after a lost checkpoint
        again = stream_upsert(spark, source, orders.schema, name, "o_custkey", "o_orderkey", f"{source}-again")
        results.append(again.select(F.lit(k).alias("arrival"), "o_custkey", "o_orderkey", "o_orderstatus"))
    return results[0].unionAll(results[1])


# ----------------------------------------------------------------- checks


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")


@query
def check_accepted_range(spark, folder):
    return row_checks.accepted_range(_lines(spark, folder), "l_quantity", 2, 49, inclusive=False)


@query
def check_at_least_one(spark, folder):
    rows = table(spark, folder, "orders").withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1)))
    return table_checks.at_least_one(rows, "urgent", ["o_custkey"])


@query
def check_at_least_one_table(spark, folder):
    rows = table(spark, folder, "orders").withColumn("never", F.when(F.col("o_totalprice") < 0, F.lit(1)))
    return table_checks.at_least_one(rows, "never")


@query
def check_cardinality_equality(spark, folder):
    return table_checks.cardinality_equality(table(spark, folder, "customer"), "c_custkey", table(spark, folder, "orders"), "o_custkey")


@query
def check_equal_rowcount(spark, folder):
    lines = _lines(spark, folder).withColumnRenamed("l_orderkey", "k")
    return table_checks.equal_rowcount(table(spark, folder, "orders").withColumnRenamed("o_orderkey", "k"), lines, ["k"])


@query
def check_equal_rowcount_table(spark, folder):
    return table_checks.equal_rowcount(table(spark, folder, "orders"), table(spark, folder, "lineitem"))


@query
def check_equality(spark, folder):
    ours = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    theirs = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.lit("O").alias("s"))
    return table_checks.equality(ours, theirs)


@query
def check_equality_exact(spark, folder):
    ours = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    theirs = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))
    return table_checks.equality(ours, theirs, exact=True)


@query
def check_equality_by_checksum(spark, folder):
    """All lines against the same lines with the dearest ones at another discount: few buckets differ."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag")
    amended = lines.withColumn("l_discount", F.when(F.col("l_extendedprice") > 104500, F.lit(0.5)).otherwise(F.col("l_discount")))
    return checksums.equality(lines, amended, exact=True)


@query
def check_cardinality_by_checksum(spark, folder):
    """How many lines the orders have, with and without the dearest lines."""
    lines = table(spark, folder, "lineitem")
    return checksums.cardinality_equality(lines, "l_orderkey", lines.filter("l_extendedprice <= 104500"), "l_orderkey")


@query
def check_expression_is_true(spark, folder):
    return row_checks.expression_is_true(_lines(spark, folder), "l_discount < 0.09 and l_returnflag <> 'R'")


@query
def check_expression_on_column(spark, folder):
    return row_checks.expression_is_true(_lines(spark, folder), "+ l_linenumber <= 50", "l_quantity")


@query
def check_fewer_rows_than(spark, folder):
    ours = table(spark, folder, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")).select(F.col("o_custkey").alias("k"))
    theirs = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    return table_checks.fewer_rows_than(ours, theirs, ["k"])


@query
def check_mutually_exclusive_ranges(spark, folder):
    """Days from one order of a customer to 200 days later must not overlap."""
    spans = table(spark, folder, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("lo"), F.date_add("o_orderdate", 200).alias("hi")
    )
    return table_checks.mutually_exclusive_ranges(spans, "lo", "hi", "o_custkey", gaps="required")


@query
def check_mutually_exclusive_ranges_table(spark, folder):
    """One order over the whole table, without a partition column."""
    spans = table(spark, folder, "orders").select(F.col("o_orderkey").alias("lo"), (F.col("o_orderkey") + F.when(F.col("o_orderkey") % 10 == 0, 2).otherwise(1)).alias("hi"))
    return table_checks.mutually_exclusive_ranges(spans, "lo", "hi", gaps="not_allowed", hot_rows=4000)


@query
def check_overlapping_ranges(spark, folder):
    """Days from an order of a customer on, longer for dear orders, so that ranges lie inside earlier ones."""
    days = F.floor(F.col("o_totalprice") / 500).cast("int")
    spans = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("lo"), F.date_add("o_orderdate", days).alias("hi"))
    return table_checks.overlapping_ranges(spans, "lo", "hi", "o_custkey")


@query
def check_overlapping_ranges_table(spark, folder):
    """One order over the whole table: dear orders reach over the keys of the next ones."""
    width = F.when(F.col("o_totalprice") > 400000, 50).otherwise(1)
    spans = table(spark, folder, "orders").select(F.col("o_orderkey").alias("lo"), (F.col("o_orderkey") + width).alias("hi"))
    return table_checks.overlapping_ranges(spans, "lo", "hi")


@query
def check_not_accepted_values(spark, folder):
    return row_checks.not_accepted_values(table(spark, folder, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW", "9-NEVER"])


@query
def check_accepted_values(spark, folder):
    return row_checks.accepted_values(table(spark, folder, "events"), "event_type", ["view", "click"])


@query
def check_not_constant(spark, folder):
    return table_checks.not_constant(table(spark, folder, "orders"), "o_orderstatus", ["o_custkey"])


@query
def check_not_empty_string(spark, folder):
    lines = _lines(spark, folder).select("l_orderkey", F.when(F.col("l_returnflag") == "R", "   ").otherwise(F.col("l_returnflag")).alias("flag"))
    return row_checks.not_empty_string(lines, "flag")


@query
def check_not_null(spark, folder):
    return row_checks.not_null(_lines(spark, folder).select("l_orderkey", F.nullif("l_linenumber", F.lit(4)).alias("n")), "n")


@query
def check_not_null_proportion(spark, folder):
    rows = table(spark, folder, "orders").withColumn("flag", F.nullif("o_orderstatus", F.lit("P")))
    return table_checks.not_null_proportion(rows, "flag", 0.5, 0.9, ["o_custkey"])


@query
def check_recency(spark, folder):
    return table_checks.recency(table(spark, folder, "events"), "ts", "hour", 18, group_by=["user_id"], as_of="2024-01-30 00:00:00")


@query
def check_recency_dates(spark, folder):
    return table_checks.recency(table(spark, folder, "orders"), "o_orderdate", "month", 6, True, ["o_custkey"], as_of=AS_OF)


@query
def check_relationships_where(spark, folder):
    return table_checks.relationships_where(
        table(spark, folder, "orders"), "o_orderkey", table(spark, folder, "lineitem"), "l_orderkey", "o_orderstatus <> 'P'", "l_returnflag <> 'N'"
    )


@query
def check_sequential_values(spark, folder):
    """Over the whole table in one order, from range partitions: orders without lines leave gaps."""
    delivered = table(spark, folder, "lineitem").select("l_orderkey").distinct()
    return table_checks.sequential_values(delivered, "l_orderkey", hot_rows=4000, partitions=5)


@query
def check_sequential_timestamps(spark, folder):
    days = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("d"))
    return table_checks.sequential_values(days, "d", 1, "month", ["o_custkey"])


@query
def check_unique_combination(spark, folder):
    return table_checks.unique_combination_of_columns(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_unique(spark, folder):
    return table_checks.unique(table(spark, folder, "orders"), "o_custkey")


@query
def check_assert_equal(spark, folder):
    lines = _lines(spark, folder).withColumn("q", F.col("l_quantity").cast("bigint") % 7)
    return row_checks.assert_equal(lines.select("l_orderkey", "l_linenumber", "q"), "q", "l_linenumber")


@query
def check_suite_lineitem(spark, folder):
    """A suite with filters, thresholds and severities in one result table."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    suite = [
        not_null_check("l_orderkey"),
        accepted_range_check("l_discount", 0, 0.09),
        accepted_range_check("l_tax", 0, 0.05, severity="warn"),
        row_check("quantity_positive", F.col("l_quantity") <= 0, where="l_returnflag = 'R'"),
        row_check("some_returned", F.col("l_returnflag") == "R", error_if="<1", warn_if="<0"),
        unique_check("l_orderkey", error_if=">1000000", warn_if=">10"),
        check(table_checks.unique_combination_of_columns, ["l_orderkey", "l_linenumber"], name="unique_line"),
        check(table_checks.relationships_where, "l_orderkey", orders, "o_orderkey", name="line_has_order"),
        check(table_checks.equal_rowcount, orders, name="as_many_lines_as_orders"),
        check(table_checks.fewer_rows_than, orders, name="fewer_lines_than_orders"),
        check(table_checks.columns_match_set, [c.upper() for c in lines.columns if c != "l_tax"] + ["l_comment"], name="columns"),
    ]
    return run_checks(lines, suite, "lineitem")
