"""Find tables by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# Catalog table types and the names used for them here.
TABLE_TYPES = {"MANAGED": "table", "BASE TABLE": "table", "EXTERNAL": "external", "EXTERNAL TABLE": "external", "MATERIALIZED VIEW": "materializedview"}


def _coarse(pattern: str) -> str:
    """A catalog pattern that fits at least what LIKE ``pattern`` does: every wildcard is any text."""
    return re.sub(r"[^a-z0-9]+", "*", pattern.lower())


def relations_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "") -> DataFrame:
    """(table_schema, table_name, table_type) of tables LIKE the patterns, whatever their case.

    The catalog lists only what fits its coarser pattern; the exact one is applied to that list.
    """
    listed = [
        (table.namespace[-1] if table.namespace else "", table.name, TABLE_TYPES.get(table.tableType, table.tableType.lower()))
        for database in spark.catalog.listDatabases(_coarse(schema_pattern))
        for table in spark.catalog.listTables(database.name, _coarse(table_pattern))
    ]
    tables = spark.createDataFrame(listed, "table_schema string, table_name string, table_type string").distinct()
    named = F.col("table_schema").ilike(schema_pattern) & F.col("table_name").ilike(table_pattern)
    return tables.filter(named & ~F.col("table_name").ilike(exclude)).orderBy("table_schema", "table_name")


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> DataFrame:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def open_relations(found: DataFrame) -> dict[str, DataFrame]:
    """The found tables by qualified name, ready for ``union_relations``."""
    spark = found.sparkSession
    names = [f"{row.table_schema}.{row.table_name}" if row.table_schema else row.table_name for row in found.collect()]
    return {name: spark.table(name) for name in names}
