"""The upsert fed by a file stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.reshape import deduplicate
from ..sources.tables import BUCKET, content_order, upsert


def stream_upsert(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    unique_key: Sequence[str] | str,
    latest_by: str,
    checkpoint: str,
    source_format: str = "parquet",
    source_options: dict[str, str] | None = None,
    **upsert_options,
) -> DataFrame:
    """Upsert all files that have arrived since the last call, then stop.

    The checkpoint remembers the files, so late rows are never skipped as they are by a high-water mark. A
    key keeps the row that is largest by ``latest_by``, stored rows included (equal ones by their content),
    so neither the order of files nor their split into batches matters, and repeating a batch after a
    failure changes nothing.
    """
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)

    def apply(batch: DataFrame, _epoch: int) -> None:
        ordered = batch.withColumn("_order", content_order(batch, latest_by, batch.columns))
        latest = deduplicate(ordered, keys, [("_order", "desc")]).drop("_order")
        upsert(latest, table, keys, latest_by=latest_by, **upsert_options)

    rows = spark.readStream.format(source_format).schema(schema).options(**(source_options or {})).load(source)
    query = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not spark.catalog.tableExists(table):  # nothing has arrived yet
        return spark.createDataFrame([], schema)
    # batches ran in a session of their own; forget the files this one has listed
    spark.catalog.refreshTable(table)
    return spark.table(table).drop(BUCKET)
