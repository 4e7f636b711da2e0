"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS``
the runs per query (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import time

import workbench
from arealis.session import build_session

HEADLINE = [
    "derived_metric_single",
    "derived_metrics_long",
    "pivot_sum",
    "pivot_mean",
    "pivot_multi_value",
    "pivot_codes_and_labels",
    "melt_then_derive",
    "header_regex_rowsum",
    "dictionary_rowsum",
    "lookup_chain",
    "outer_join_many",
    "flat_catalogue",
    "join_coverage_audit",
    "union_with_precedence",
    "metric_metadata_rows",
    "content_ids",
    "title_case",
    "forward_fill",
    "stub_paths",
    "latest_record",
    "drop_last_rows",
    "dense_row_number",
    "batch_tables",
    "page_links",
    "nested_json_rows",
    "archive_member_pick",
    "dissolve_area",
    "dissolve_rings",
    "publish_metrics",
    "publish_partitions",
    "publish_once",
    "job_minimum",
    "job_long_mean",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cores = cpus if cpus.isdigit() else "8"
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            workbench.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
