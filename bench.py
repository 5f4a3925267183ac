"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is built and evaluated in full (all columns of all rows) into Spark's no-op sink, so
the jobs that a query runs while it is built count as well. Each query runs once untimed on the
smallest tables first, so that class loading and compilation of a fresh JVM are not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from musterline.plans.queries import QUERIES
from musterline.session import local_session

HEADLINE = (
    "csv_contract_read",
    "contract_split",
    "full_reload",
    "json_flatten",
    "merge_sources",
    "batch_conflicts",
    "update_rows",
    "search_combined",
    "dedup_keep_first",
    "clean_roster",
    "kpis",
    "dept_summary",
    "dept_summary_with_total",
    "top_earners",
    "correlation_matrix",
    "salary_histogram",
    "salary_box_stats",
    "salary_density",
    "cumulative_headcount",
    "cumulative_headcount_rows",
    "directory_export",
    "kpi_report_long",
)


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{folder}/orders.parquet").count()
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        run(spark, name, smallest if os.path.isdir(smallest) else folder)
    seconds = {name: run(spark, name, folder) for name in HEADLINE}
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "roster_rows": rows,
                "rows_per_sec": {n: round(rows / s) for n, s in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
