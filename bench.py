"""Time the headline operations; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)

Deriving the order files from the given tables is set-up and reported apart. ``ingest_*`` run the
whole pipeline (CSV to raw layer, rules, quarantine, upsert, run metrics); the other entries run
one operation each over the whole stored result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.plans.ingest import ingest_files  # noqa: E402
from ordermill.plans.store import OrderStore  # noqa: E402
from ordermill.plans.views import refresh_view  # noqa: E402
from ordermill.session import configure, fresh_dir  # noqa: E402
from ordermill.verify import inputs, queries  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

SCANS = ["csv_scan", "rule_parse_price", "rule_items_json", "corrections_audit", "classify"]
READS = [
    "orders_by_status", "orders_by_customer", "high_value_orders_by_city", "orders_by_payment",
    "orders_needing_review", "sales_by_city", "top_products", "top_customers", "sales_by_month",
    "sales_by_day", "status_distribution", "items_normalized", "table_counts", "periodic_report",
    "size_sample",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ordermill-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "20g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.time()
        result = action()
        seconds[name] = round(time.time() - start, 3)
        return result

    def run(name):
        query = queries.queries()[name]
        timed(name, lambda: query(spark, SF_DIR).write.format("noop").mode("overwrite").save())

    start = time.time()
    first, second = (inputs.order_files(spark, SF_DIR, n) for n in (1, 2))
    everything = inputs.order_files(spark, SF_DIR)
    setup = round(time.time() - start, 3)

    store = OrderStore(spark, fresh_dir(spark, "bench"))
    timed("ingest_first", lambda: ingest_files(store, first, "run-1"))
    timed("view_daily_full", lambda: refresh_view(store, "daily_sales_summary"))
    timed("view_products_full", lambda: refresh_view(store, "top_products_summary"))
    timed("ingest_changes", lambda: ingest_files(store, second, "run-2"))
    timed("view_daily_incremental", lambda: refresh_view(store, "daily_sales_summary"))
    timed("view_products_incremental", lambda: refresh_view(store, "top_products_summary"))
    timed("ingest_unchanged", lambda: ingest_files(store, second, "run-3"))
    rows = {
        r["id_run"]: (r["read_rows"], r["count_inserted"], r["count_updated"], r["count_unchanged"])
        for r in store.run_metrics().collect()
    }
    for name in SCANS:
        run(name)
    full = timed("ingest_all", lambda: inputs.store(spark, SF_DIR))
    for name in READS:
        run(name)
    total = round(sum(seconds.values()), 3)
    loaded = full.run_metrics().first()["read_rows"]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "setup_seconds": setup,
                "rows_inserted_updated_unchanged": rows,
                "ingest_rows_per_second": round(loaded / seconds["ingest_all"], 1),
                "order_files": everything.rsplit("/", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
