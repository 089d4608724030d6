"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times, all rows computed and none fetched; the
median counts. `BENCH_QUERIES=all` takes every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradeloom.plans.catalog import queries  # noqa: E402
from tradeloom.session import build_session  # noqa: E402

HEADLINES = [
    "dw_fact_sales",
    "mart_fact_sales",
    "mart_fact_product_sales",
    "mart_fact_customer_sales",
    "dw_monthly_category_trend",
    "dw_top_products_monthly",
    "dw_top_customers",
    "dw_weekly_category_sales",
    "dw_median_sales",
    "dw_rfm_segments",
    "mart_supplier_scorecard",
    "mart_customer_ltv",
    "mart_sales_dashboard",
    "mart_supplier_customer_links",
    "stock_movements_apply",
    "order_totals",
    "dq_score_corrected",
    "postal_segments",
]


def _run(query, spark, directory) -> float:
    start = time.perf_counter()
    query(spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("tradeloom-bench")
    known = queries()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(known) if wanted == "all" else wanted.split(",") if wanted else HEADLINES
    seconds = {}
    for name in names:
        _run(known[name], spark, directory)
        seconds[name] = round(statistics.median(_run(known[name], spark, directory) for _ in range(runs)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
