"""The seven source tables of the bank and how their CSV files are read."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import setting


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


_OVERWRITING = threading.Lock()

# Everything is read as text; the staging plans cast it. No inference pass.
SCHEMAS = {
    "customers": _strings("customer_id", "first_name", "last_name", "email", "city", "credit_score", "created_at"),
    "accounts": _strings("account_id", "customer_id", "account_type", "balance_usd", "open_date"),
    "branches": _strings("branch_id", "branch_name", "manager_name", "city", "country"),
    "cards": _strings("card_id", "account_id", "card_type", "expiration_date"),
    "loans": _strings("loan_id", "customer_id", "loan_amount", "interest_rate", "start_date"),
    "merchants": _strings("merchant_id", "merchant_name", "city"),
    "transactions": _strings("transaction_id", "account_id", "merchant_id", "amount_usd", "transaction_date"),
}

# CSV options of every source.
CSV_OPTIONS = {"header": "true", "sep": ",", "nullValue": "", "dateFormat": "yyyy-MM-dd"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, options: Mapping[str, str] | None = None, file_format: str = "csv"
) -> DataFrame:
    """A directory of files as a table; the caller's options win over the defaults.

    Without a schema the types are inferred, which reads the files once more.
    """
    merged = dict(CSV_OPTIONS) if file_format == "csv" else {}
    merged.update(options or {})
    if "delimiter" in merged:
        merged["sep"] = merged.pop("delimiter")
    reader = spark.read.options(**merged)
    if schema is not None:
        reader = reader.schema(schema)
    elif file_format == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.format(file_format).load(path)


def read_source(spark: SparkSession, name: str, root: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Source ``name`` from ``root/name/``, a folder of CSV files."""
    return read_csv(spark, f"{root.rstrip('/')}/{name}", SCHEMAS[name], options)


def create_table_from_csv(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    source_format: str = "csv",
    table_format: str = "parquet",
) -> DataFrame:
    """Create or replace a table from files."""
    read_csv(spark, path, schema, options, source_format).write.mode("overwrite").format(table_format).saveAsTable(table)
    return spark.table(table)


def load_source(spark: SparkSession, name: str, root: str, database: str | None = None, table_format: str = "parquet") -> DataFrame:
    """Load one source of the registry into a table of the same name."""
    table = f"{database}.{name}" if database else name
    return create_table_from_csv(spark, table, f"{root.rstrip('/')}/{name}", SCHEMAS[name], table_format=table_format)


def load_all(spark: SparkSession, root: str, database: str | None = None, table_format: str = "parquet") -> dict[str, DataFrame]:
    return {name: load_source(spark, name, root, database, table_format) for name in SCHEMAS}


def with_date_parts(df: DataFrame, date_column: str) -> DataFrame:
    """Add the ``year``, ``month`` and ``day`` a partitioned table is split by."""
    day = F.col(date_column).try_cast("timestamp")
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def create_partitioned_if_absent(
    df: DataFrame, table: str, date_column: str | None = None, partition_by: tuple[str, ...] = ("year", "month", "day"), table_format: str = "parquet"
) -> DataFrame:
    """Create a partitioned table unless it exists already."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        rows = with_date_parts(df, date_column) if date_column else df
        # one task per partition value set, split further by size at run time
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
        rows.write.format(table_format).partitionBy(*partition_by).mode("ignore").saveAsTable(table)
    return spark.table(table)


def insert_overwrite(df: DataFrame, table: str, dynamic: bool = True) -> None:
    """Replace the partitions present in ``df`` (or the whole table)."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    # insertInto takes the mode from the session, not from a writer option; the lock keeps two writers of a
    # session from changing it under each other
    with _OVERWRITING, setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic" if dynamic else "static"):
        df.select(*columns).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
