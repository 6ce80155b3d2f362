"""Times the headline queries and prints one JSON line.

Each query is planned and run to a sink that discards rows; the first run warms up,
the reported time is the median of the following ones.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import workload.queries  # noqa: F401
from tidemark.session import build_session
from workload.registry import QUERIES

HEADLINE = [
    "dedup_latest", "upsert_scd1", "changed_rows", "pay_fact_payments", "daily_payment_summary",
    "revenue_by_merchant", "customer_lifetime_value", "merchant_settlement_daily", "fact_rides",
    "city_performance", "driver_earnings", "rider_ltv", "surge_pricing", "scd2_rebuild",
    "pit_login_attempts", "pit_join", "pit_join_direct", "weather_daily", "crypto_movers",
    "earthquake_daily", "airquality_daily", "flatten_earthquake", "version_diff", "as_of",
    "upsert_table", "compact_check", "stream_dedupe",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.checkpoint.dir": os.environ.get("CHECKPOINT_DIR", "/tmp/tidemark-shared")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split():
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    result = {
        "metric": "headline queries, total of warm medians", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cores": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
