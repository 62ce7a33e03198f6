"""Incremental reads by file: what was read is remembered per file, not as the largest value of a column.

Rows that come late, or with a time equal to the mark, lie in files that were not read yet, so none is passed over.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.ordered import same_keys
from ..session import materialise


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """path, modified and bytes of the files below a folder; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def unread_files(spark: SparkSession, path: str, marks: str) -> DataFrame:
    """Files that the table ``marks`` does not hold, or holds with another time or size."""
    found = files_of(spark, path)
    if not spark.catalog.tableExists(marks):
        return found
    return found.alias("f").join(spark.table(marks).alias("m"), same_keys("f", "m", found.columns), "left_anti")


def read_unread(
    spark: SparkSession,
    path: str,
    marks: str,
    schema: T.StructType,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows of the unread files, those files). Save the rows, then call ``mark_read`` with the files.

    The files are listed once and named to the scan, so one that arrives later waits for the next call. If a job fails
    between saving and marking, or a file is replaced while it is read, its rows come again: save them by key. The names
    of unread files go through the driver, which lists the files of every scan anyway.
    """
    files = materialise(unread_files(spark, path, marks), "unread")
    names = [row["path"] for row in files.select("path").collect()]
    if not names:
        return spark.createDataFrame([], schema), files
    return spark.read.format(file_format).options(**(options or {})).schema(schema).load(names), files


def mark_read(files: DataFrame, marks: str) -> None:
    files.write.mode("append").format("parquet").saveAsTable(marks)
