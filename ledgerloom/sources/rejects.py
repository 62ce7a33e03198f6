"""Reading delimited files without losing what does not fit their schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import materialise
from .registry import read_csv

RECORD = "_rejected_record"
FILE = "_rejected_file"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected records) of a directory of files.

    A record is rejected if it has too few or too many fields, or a field that is not of its type, where ``read_csv``
    gives NULLs. Rejects keep the whole record and the file it came from, nothing else. Files are read once, into the
    scratch folder; empty lines are no records. Modes other than permissive are refused, and so is a schema that has the
    names of the two columns of rejects.
    """
    given = {k.lower(): v for k, v in (options or {}).items()}
    if given.get("mode", "permissive").lower() != "permissive":
        raise ValueError("rejected records are kept in permissive mode only")
    if {RECORD, FILE} & set(schema.names):
        raise ValueError(f"{RECORD} and {FILE} are the columns of rejected records")
    with_record = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    # without column pruning, or a record would only be judged by the columns that are read
    wanted = {**(options or {}), "columnNameOfCorruptRecord": RECORD, "columnPruning": "false"}
    rows = read_csv(spark, path, with_record, wanted).select("*", F.col("_metadata.file_path").alias(FILE))
    stored = materialise(rows.withColumn(FILE, F.when(F.col(RECORD).isNotNull(), F.col(FILE))), "checked")
    accepted = stored.filter(F.col(RECORD).isNull()).select(*[F.col(f"`{n}`") for n in schema.names])
    return accepted, stored.filter(F.col(RECORD).isNotNull()).select(RECORD, FILE)


def create_table_and_rejects(
    spark: SparkSession, table: str, path: str, schema: T.StructType, options: Mapping[str, str] | None = None, table_format: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Create or replace ``table`` and ``<table>__rejects`` from files."""
    written = []
    for name, rows in zip((table, f"{table}__rejects"), read_csv_checked(spark, path, schema, options)):
        rows.write.mode("overwrite").format(table_format).saveAsTable(name)
        written.append(spark.table(name))
    return written[0], written[1]
