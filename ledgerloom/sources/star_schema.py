"""The bank's source tables, derived from a sales star schema.

Keys map one to one, amounts are scaled into the ranges of the bank's bands,
and what the star schema lacks is computed from the keys by fixed arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2002-01-01 00:00:00"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def money(cents: Column) -> Column:
    """Whole cents as decimal(15,2)."""
    return (cents.cast("bigint").cast("decimal(15,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(15,2)")


def day_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int")).cast("timestamp")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Surname from the market segment, score 300..850, tenure from the key."""
    key = F.col("c_custkey")
    nation = read(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    return (
        read(spark, folder, "customer")
        .join(nation, "c_nationkey", "left")
        .select(
            key.alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@bank.example")).alias("email"),
            "city",
            (300 + (key * 37) % 551).alias("credit_score"),
            day_after("1990-01-01", (key * 7) % 4000).alias("created_at"),
        )
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """One account per customer row; two neighbours share the even one as owner."""
    key = F.col("c_custkey")
    return read(spark, folder, "customer").select(
        key.alias("account_id"),
        (key - key % 2).alias("customer_id"),
        F.col("c_mktsegment").alias("account_type"),
        money(F.round(F.col("c_acctbal") * 1500)).alias("balance_usd"),
        day_after("1991-01-01", (key * 13) % 3900).alias("open_date"),
    )


def cards(spark: SparkSession, folder: str) -> DataFrame:
    """One card per account, a third each of credit, debit and prepaid."""
    key = F.col("c_custkey")
    kind = F.when(key % 3 == 0, "Credit").when(key % 3 == 1, "Debit").otherwise("Prepaid")
    return read(spark, folder, "customer").select(
        (key + 1000000).alias("card_id"),
        key.alias("account_id"),
        kind.alias("card_type"),
        day_after("2001-01-01", (key * 17) % 1100).alias("expiration_date"),
    )


def loans(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return read(spark, folder, "part").select(
        key.alias("loan_id"),
        key.alias("customer_id"),
        money(F.round(F.col("p_retailprice") * 10000)).alias("loan_amount"),
        (F.col("p_size") % 15).alias("interest_rate"),
        day_after("1993-01-01", (key * 11) % 3200).alias("start_date"),
    )


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city"))
    return (
        read(spark, folder, "supplier")
        .join(nation, "s_nationkey", "left")
        .select(F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name"), "city")
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """An order is a transaction at the supplier with the smallest key in it."""
    shop = read(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("merchant_id"))
    return (
        read(spark, folder, "orders")
        .join(shop, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("account_id"),
            "merchant_id",
            money(F.round(F.col("o_totalprice") * 4)).alias("amount_usd"),
            F.col("o_orderdate").cast("timestamp").alias("transaction_date"),
        )
    )


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions with a time of day; the user is the account."""
    return read(spark, folder, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        (F.col("event_id") % 7).alias("merchant_id"),
        money(F.round(F.col("value") * 100)).alias("amount_usd"),
        F.col("ts").cast("timestamp").alias("transaction_date"),
    )


def branches(spark: SparkSession, folder: str) -> DataFrame:
    """A branch per supplier; some have no city or country."""
    key = F.col("s_suppkey")
    nation = read(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    region = read(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        read(spark, folder, "supplier")
        .join(nation, "s_nationkey", "left")
        .join(region, "n_regionkey", "left")
        .select(
            key.alias("branch_id"),
            F.concat(F.lit("Branch "), F.col("s_name")).alias("branch_name"),
            F.concat(F.lit("Manager "), key.cast("string")).alias("manager_name"),
            F.when(key % 4 == 0, "").otherwise(F.col("n_name")).alias("city"),
            F.when(key % 5 == 0, "").otherwise(F.col("r_name")).alias("country"),
        )
    )
