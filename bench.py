"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 2) set
the input, the cores and the timed runs after one warm-up; a query's time is its median run.
"""

import json
import os
import statistics
import time

from catalog import QUERIES
from gridtally.session import build_session, release_all

HEADLINE = (
    "cost_by_band",
    "unit_price",
    "nearest_plan",
    "plan_distribution",
    "baseline",
    "hourly_work_type_share",
    "cost_trend_day",
    "daily_sales_trend",
    "monthly_usage_cost",
    "compare_months_cost",
    "report_row",
    "describe",
    "position",
    "lags",
    "rolling",
    "rolling_before",
    "event_series_blocks",
    "sequences",
    "lags_across",
    "future_last_rolling",
    "target_encode_oof",
    "robust_scale",
    "iqr_filter",
    "time_folds",
    "weighted_ensemble",
    "stream_progress_vs_baseline",
    "isolation_filter",
    "boosted_trees",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    release_all(spark)
    spark.stop()


if __name__ == "__main__":
    main()
