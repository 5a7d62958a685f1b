"""The whole batch: stage, profile, snapshot, dashboards, benchmarks, history
and deep dive, each written once as a parquet table.

    python -m paytrail.plans.pipeline SF_DIR|tables:SOURCE [OUT_DIR [AS_OF]]

SF_DIR holds the order tables from which the six workforce tables are derived;
``tables:SOURCE`` names the six tables themselves, as ``read_tables`` takes them.
AS_OF (YYYY-MM-DD) is the run date for tenures and open periods.

Shared results are stored and read back instead of being recomputed: the
snapshot feeds the dashboards and the benchmarks, the stored history feeds the
deep dive (its definition is a filter of the history).
"""

from __future__ import annotations

import datetime as dt
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.config import AS_OF_DEFAULT, checkpoint_root
from paytrail.operators.profile import reconcile_counts
from paytrail.plans import catalog, dashboard, history, requirements
from paytrail.plans.benchmark import BENCHMARKS, all_benchmarks
from paytrail.plans.snapshot import current_snapshot
from paytrail.sources.staging import read_tables, warehouse

PROFILE = [
    "records_per_employee_employee", "records_per_employee_title", "records_per_employee_salary",
    "records_per_employee_department", "records_per_employee_manager", "managers_per_department",
    "distinct_employees", "latest_to_dates_salary", "latest_to_dates_department",
    "latest_to_dates_title", "key_violations", "relationship_types", "former_employee_records",
]


def run(spark: SparkSession, sf_dir: str, out: str | None = None,
        as_of: dt.date = AS_OF_DEFAULT) -> dict[str, float]:
    """Run every stage; return seconds per written table."""
    own = read_tables(spark, sf_dir.removeprefix("tables:")) if sf_dir.startswith("tables:") else None
    out = (out or f"{checkpoint_root(spark)}/paytrail-out/{uuid.uuid4().hex[:8]}").rstrip("/")
    times: dict[str, float] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        t0 = time.time()
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        times[name] = round(time.time() - t0, 3)
        return spark.read.parquet(f"{out}/{name}")

    t0 = time.time()
    wh = warehouse(spark, sf_dir, tables=own)
    wh.build()
    times["stage"] = round(time.time() - t0, 3)
    t = wh.staged()

    if own is not None:
        write("rejected_rows", wh.rejected())
    for name in PROFILE:
        write(name, catalog.QUERIES[name](spark, sf_dir))

    snap = write("current_employee_snapshot", current_snapshot(t, as_of))
    write("reconcile_counts", reconcile_counts(t, snap))
    write("average_payrise", requirements.average_payrise(current_snapshot(t, as_of, keep_previous=True)))
    write("title_history_months", requirements.title_months(t, as_of))
    write("department_history_months", requirements.department_months(t, as_of))
    for level in ("company", "department", "title"):
        write(f"{level}_level_dashboard", dashboard.level_dashboard(snap, level))
    allb = write("benchmarks", all_benchmarks(snap))
    for name, (col, out_col) in BENCHMARKS.items():
        write(f"{name}_benchmark", allb.filter(F.col("benchmark") == name)
              .select(col, F.col("benchmark_salary").alias(out_col)))

    hist = write("historic_employee_records",
                 history.historic_employee_records(t, as_of, snapshot=snap))
    write("employee_deep_dive", hist.filter(F.col("event_order") <= 5))
    return times


if __name__ == "__main__":
    from paytrail.config import session
    spark = session()
    day = dt.date.fromisoformat(sys.argv[3]) if len(sys.argv) > 3 else AS_OF_DEFAULT
    res = run(spark, sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None, day)
    print(res)
