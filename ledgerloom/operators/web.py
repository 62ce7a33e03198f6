"""Page traffic by host, path and query parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.expressions import url_host, url_parameter, url_path


def host_counts(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.groupBy(url_host(url).alias("host")).agg(F.count(F.lit(1)).alias("n_pages"))


def parameter_counts(pages: DataFrame, parameter: str, url: str = "url") -> DataFrame:
    return pages.groupBy(url_parameter(url, parameter).alias(parameter)).agg(F.count(F.lit(1)).alias("n_pages"))


def path_counts(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.groupBy(url_host(url).alias("host"), url_path(url).alias("path")).agg(F.count(F.lit(1)).alias("n_pages"))


def top_paths(pages: DataFrame, k: int = 3, url: str = "url", salts: int = 64) -> DataFrame:
    """The ``k`` most frequent paths of each host, ties by path.

    Paths are ranked inside a slice of their host first, so a host with very
    many paths hands at most ``salts * k`` candidates to the final ranking.
    """
    order = [F.desc("n_pages"), F.asc("path")]
    sliced = path_counts(pages, url).withColumn("_slice", F.pmod(F.xxhash64("path"), F.lit(salts)))
    near = sliced.withColumn("_r", F.row_number().over(Window.partitionBy("host", "_slice").orderBy(*order)))
    final = near.filter(F.col("_r") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(*order)))
    return final.filter(F.col("rank") <= k).select("host", "path", "n_pages", "rank")
