"""Surrogate keys over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import surrogate_key


def with_surrogate_key(df: DataFrame, cols: Sequence[str], name: str = "surrogate_key", null_as_empty: bool = False) -> DataFrame:
    return df.withColumn(name, surrogate_key(cols, null_as_empty))


def key_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys met more than once: how many rows, and how many different inputs.

    More than one input behind a key is a collision, otherwise the rows are
    duplicates. Rows are folded per distinct input first, so a hot input costs
    one row per task and only distinct inputs are hashed.
    """
    inputs = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return (
        with_surrogate_key(inputs, cols, "_key")
        .groupBy(F.col("_key").alias("surrogate_key"))
        .agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_inputs"))
        .filter(F.col("n_rows") > 1)
        .withColumn("is_collision", F.col("n_inputs") > 1)
    )
