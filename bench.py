"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: data folder, BENCH_CPUS: cores, BENCH_RUNS: warm runs per query
(the median counts). Every query is written out in full through Spark's noop
sink, so nothing is skipped and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerloom.session import drop_scratch  # noqa: E402
from registry import QUERIES  # noqa: E402

HEADLINE = """
stg_transactions customer_360 dim_customers customer_card_info loan_portfolio loan_portfolio_analysis
transaction_enriched fct_transactions fct_account_summary clv_analysis segment_analysis transaction_patterns
txn_rolling_measures txn_rolling_measures_split txn_percentile_bands customer_wealth_rank_ntile order_priority_rank_ntile
flag_price_percentiles_split order_running_total dedupe_latest_order pivot_priority_counts unpivot_lineitem_measures
union_relations_exclude date_spine_daily_orders surrogate_keys surrogate_key_report mask_customers column_value_freq price_histogram
share_of_total url_top_paths proximity_pairs upsert_orders refresh_in_batches
check_cardinality_equality check_equality check_mutually_exclusive_ranges check_relationships_where check_sequential_values
check_unique_combination check_suite_lineitem
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        once(name)  # warm up code generation and file listings
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name:36s} {seconds[name]:8.3f}", file=sys.stderr)
        drop_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
