"""Benchmark: stage the warehouse, then run the headline queries end to end.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_ALL=1 to time every registered query.  Prints one JSON line; "pipeline"
is the end-to-end batch that writes every output table.
Each query is executed completely through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paytrail.config import checkpoint_root, session  # noqa: E402
from paytrail.plans import pipeline  # noqa: E402
from paytrail.plans.catalog import QUERIES  # noqa: E402
from paytrail.sources.staging import warehouse  # noqa: E402

HEADLINE = [
    "current_snapshot", "company_dashboard", "department_dashboard", "title_dashboard",
    "benchmark_title", "salary_change", "records_per_employee_salary",
    "latest_to_dates_salary", "key_violations", "reconcile_counts", "history_periods",
    "historic_employee_records", "employee_deep_dive",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = session(f"local[{cpus}]", shuffle_partitions=parts, app="paytrail-bench")
    root = f"{checkpoint_root(spark)}/paytrail-bench-{uuid.uuid4().hex[:8]}"
    times: dict[str, float] = {}

    # Untimed: start the scheduler and executors with a trivial job, so that
    # "stage" measures staging rather than session start-up.
    spark.range(1000).selectExpr("sum(id)").collect()

    t0 = time.time()
    warehouse(spark, sf_dir, root=root).build(force=True)
    times["stage"] = round(time.time() - t0, 3)

    names = sorted(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    # The whole batch (profile, snapshot, dashboards, benchmarks, history, deep
    # dive) written as tables, on the warehouse staged above.
    t0 = time.time()
    pipeline.run(spark, sf_dir, f"{root}/pipeline-out")
    times["pipeline"] = round(time.time() - t0, 3)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus,
                      "shuffle_partitions": parts}))


if __name__ == "__main__":
    main()
