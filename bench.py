"""Time the headline queries and print one JSON line.

Each query runs once cold and then three times; the median of the three counts. Results go to Spark's `noop` sink, so every
row is produced and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "scan_columns_filter",
    "pricing_summary",
    "customer_distribution",
    "shipping_priority",
    "local_supplier_volume",
    "national_market_share",
    "large_volume_customers",
    "revenue_by_customer_region",
    "order_total_drift",
    "in_subquery_having",
    "suite_in_one_pass",
    "violations_of_uniqueness",
    "dedupe_keep_highest",
    "telemetry_bronze_to_gold",
    "account_day_summary",
    "trips_with_zones",
    "waiting_time_by_zone",
    "median_exact",
    "array_in_order",
    "row_numbers_contiguous",
    "top_k_by_count",
    "seeded_sample",
    "page_texts",
    "nearest_vectors",
    "forecast_per_series",
    "diff_rows_by_key",
    "merge_three_way",
    "apply_change_feed",
    "overwrite_partitions",
    "import_once_then_forced",
    "model_chain",
    "stream_hourly_stats",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = build_session(cores, "bench", partitions=cores)
    warm, cold = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(rounds + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median seconds over headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "cpus": cores,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
