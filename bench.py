"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores. The end-to-end
query warms the session up; then every query is timed once. The full result is
materialised, not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillforge.plans.catalog import QUERIES  # noqa: E402
from tillforge.session import create_session  # noqa: E402

HEADLINE = [
    "validation_report",
    "clean_rows",
    "enrich_feed",
    "fact_sales",
    "fact_load",
    "quarantine_rows",
    "scorecard",
    "store_failure_rate",
    "reconciliation",
    "report_region_store",
    "report_top5_products",
    "report_top10_products",
    "report_monthly",
    "report_employee",
    "report_repeat_customers",
    "report_weekend",
    "report_region",
    "report_category",
    "report_store_aov",
    "report_top10_stores",
    "report_audit_by_status",
    "execution_summary",
    "scd1_apply_product",
    "scd1_apply_customer",
    "classify_files",
    "watermark_upsert",
    "clean_documents",
    "redact_documents",
    "stream_validate_feed",
]


def run(spark, name: str, base: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{base}/lineitem.parquet").count()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for _ in range(2):
        run(spark, "fact_sales", base)
    for name in names:
        times[name] = round(run(spark, name, base), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    end_to_end = times.get("fact_sales")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
                "feed_rows": lines,
                "validate_transform_rows_per_sec": round(lines / end_to_end) if end_to_end else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
