"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line.

Each query runs once to warm up and then three times; its median counts. Results
go to Spark's noop sink, so the time is that of the query and not of collecting.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.plans import queries
from millrace.session import build_session, drop_stages

HEADLINE = (
    "sales_by_region join_left join_broadcast join_sortmerge join_composite semi_join big_spenders "
    "group_multi_agg group_two_keys pivot_sum stat_aggregates exact_median partial_merge_agg run_groups "
    "running_total moving_avg interpolate count_tumbling enumerate_rows sort_multi top_k top_k_per_group "
    "dedup_first dedup_last mark_duplicates derive_columns line_total num_format text_normalize log_parse "
    "array_hof nested_total json_flatten record_validate dq_report dq_rejects fillna_stats clean_order_feed "
    "csv_roundtrip parquet_roundtrip partitioned_read load_partition_replace load_upsert salted_sum salted_join "
    "map_partitions etl_normalize_orders etl_partitioned_files"
).split()


def seconds(run, spark, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "millrace-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    built, cold, warm = queries(), {}, {}
    for name in names:
        cold[name] = round(seconds(built[name], spark, folder), 3)
        warm[name] = round(statistics.median(seconds(built[name], spark, folder) for _ in range(3)), 3)
        drop_stages(spark)
    result = {
        "metric": "sum of median warm seconds of the headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
