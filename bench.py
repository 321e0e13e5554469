"""Time the headline queries and print one JSON line.

Each query runs once to warm up on the smallest tables and then ``BENCH_RUNS`` times on ``BENCH_SF_DIR``; the best run counts.
Every run consumes all rows of the result without bringing them to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from landfall.queries import QUERIES  # noqa: E402
from landfall.session import build_session  # noqa: E402

HEADLINE = (
    "count_on_date", "daily_load_counts", "latest_per_group", "latest_with_ties", "natural_order", "natural_ends",
    "string_projection", "period_date", "vars_to_map", "render_template", "json_flatten", "params_explode", "schema_contract",
    "business_days", "due_schedules", "expected_found", "completeness", "purge_by_date", "reload_date", "close_open_runs",
    "csv_roundtrip", "load_csv", "parquet_append", "reload_day_partition", "reload_plain_table", "purge_other_partition",
    "archive_by_period", "landing_report", "validate_and_close", "run_scripts",
)


def run(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    warm = small if os.path.isdir(small) else folder
    times = {}
    for name in HEADLINE:
        run(spark, name, warm)
        times[name] = round(min(run(spark, name, folder) for _ in range(runs)), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
