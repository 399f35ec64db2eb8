"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_RUNS the timed runs
per query after one warm-up; the fastest timed run counts. Every query is timed from the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martloom import catalogue  # noqa: E402
from martloom.session import build_session  # noqa: E402

HEADLINE = [
    "d_calendar",
    "d_customer_max_city",
    "d_item",
    "f_activity",
    "f_daily_sales",
    "stage_orders_dedup",
    "d_customer_insert_new",
    "f_sales_signed",
    "f_sales_upsert_two_loads",
    "customer_retention_weeks",
    "conform_sources",
    "merge_product",
    "merge_f_order",
    "customer_report_first_load",
    "customer_report_increment",
    "dm_timestamps",
    "dm_products_latest",
    "fct_product_sales",
    "stage_documents_by_time",
    "stream_upsert",
    "dq_results",
]


def timed(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        queries[name] = round(min(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
