"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from storelens.plans.registry import queries
from storelens.session import SESSION_CONF

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "customer_ltv_top10", "sales_repair", "null_profile_compare", "price_dense_rank",
    "units_by_category", "sales_by_month", "customer_features", "customer_stats",
    "category_diversity", "latest_partition_report", "event_rollup_exact",
    "event_sketch_error", "retention_daily", "retention_first_visit", "audit_changes",
    "archive_split", "archive_report", "relay_roundtrip", "relay_stream",
    "parse_purchases", "parse_customers", "row_hash_dedupe", "typed_stream", "land_raw",
    "mask_pii", "duplicate_ratio", "csv_folder_stream", "page_links", "crawl_frontier",
    "item_fields",
]


def build() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("storelens-bench")
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def main(names: list[str]) -> None:
    spark = build()
    known = queries()
    spark.read.parquet(f"{SF_DIR}/region.parquet").count()
    seconds: dict[str, float] = {}
    for name in names:
        for _ in ("warm-up", "measured"):
            start = time.perf_counter()
            known[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
