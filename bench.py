"""Headline timings: the full refresh end to end and the main queries on their own.

Prints one JSON line. The folder of test tables and the number of local threads
come from BENCH_SF_DIR and BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import time

from tillstar.config import WarehouseConfig
from tillstar.plans.catalog import QUERIES
from tillstar.plans.pipeline import run_pipeline
from tillstar.session import build_session, scratch_path
from tillstar.sources import star_tables

HEADLINE = (
    "raw_transactions",
    "stg_transactions",
    "stg_transactions_rejected",
    "validation_log",
    "dim_products",
    "fact_transactions",
    "dim_customers",
    "fk_orphans",
    "row_outcomes",
    "top_store_for_product",
    "sales_by_store_month",
    "sales_by_category",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    star_tables.raw_frame(spark, folder, "raw_stores").count()  # start-up is not measured

    seconds: dict[str, float] = {}
    started = time.monotonic()
    raw = {
        name: star_tables.raw_frame(spark, folder, f"raw_{name}")
        for name in ("transactions", "products", "staff", "managers", "stores")
    }
    first_day, last_day = star_tables.sales_years(spark, folder)
    config = WarehouseConfig(
        spine_start=first_day,
        spine_end=last_day,
        constraint_policy="report",
    )
    result = run_pipeline(spark, raw, scratch_path(spark, "bench"), config)
    seconds["full_refresh"] = round(time.monotonic() - started, 3)
    sales_rows = result.metrics.rows_of("raw.transactions")

    for name in HEADLINE:
        started = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)

    print(json.dumps({
        "metric": "total seconds of the full refresh and the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
        "full_refresh_rows_per_sec": round(sales_rows / seconds["full_refresh"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
