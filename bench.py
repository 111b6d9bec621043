"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 4)
    BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
    BENCH_ONLY    comma-separated query names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.catalog import QUERIES
from ledgerlens.session import build_session

HEADLINE = [
    "staged_transactions", "enriched_transactions", "customer_transaction_summary",
    "monthly_payment_performance", "customers_360", "cohort_retention", "rfm_segmentation",
    "fraud_events", "merchant_risk_scorecard", "payment_performance", "rfm", "merchant_scorecard",
    "first_purchase_retention", "headline_metrics", "segment_summary", "batch_explain",
    "forecast_revenue_by_currency", "fraud_features", "fraud_reason_codes", "drift_feature_psi",
    "aml_flags", "executive_monthly_health", "executive_repeat_fraud_customers",
    "quality_raw_tables", "canonical_transactions", "stream_rows", "stream_merge_rows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY", "")
    names = list(QUERIES) if only == "all" else only.split(",") if only else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(2 * cpus),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "6g"), spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run or runs == 0:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
