"""Average current salary per company tenure, gender, department and title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.operators.joins import materialize_once

BENCHMARKS = {
    "tenure": ("company_tenure_years", "tenure_benchmark_salary"),
    "gender": ("gender", "gender_benchmark_salary"),
    "department": ("department", "department_benchmark_salary"),
    "title": ("title", "title_benchmark_salary"),
}


def all_benchmarks(snapshot: DataFrame) -> DataFrame:
    """The four benchmarks in one pass over the snapshot (GROUPING SETS),
    tagged by ``benchmark``; each output has one row per distinct value."""
    cols = [c for c, _ in BENCHMARKS.values()]
    g = snapshot.groupingSets([[c] for c in cols], *cols).agg(
        F.avg("salary").alias("benchmark_salary"),
        *[F.grouping(c).alias(f"__g_{c}") for c in cols])
    tag = F.lit(None).cast("string")
    for name, (c, _) in BENCHMARKS.items():
        tag = F.when(F.col(f"__g_{c}") == 0, F.lit(name)).otherwise(tag)
    return g.select(tag.alias("benchmark"), *cols, "benchmark_salary")


def benchmark(snapshot: DataFrame, name: str) -> DataFrame:
    col, out = BENCHMARKS[name]
    return snapshot.groupBy(col).agg(F.avg("salary").alias(out))


def _split(allb: DataFrame) -> dict[str, DataFrame]:
    return {name: allb.filter(F.col("benchmark") == name)
            .select(col, F.col("benchmark_salary").alias(out))
            for name, (col, out) in BENCHMARKS.items()}


def stored_benchmarks(snapshot: DataFrame) -> dict[str, DataFrame]:
    """Four benchmark frames cut from one grouping-sets aggregation that runs
    once and is checkpointed to the cluster's checkpoint folder (the joins that
    use it read a small stored table instead of repeating the snapshot's
    lineage)."""
    return _split(materialize_once(all_benchmarks(snapshot), "benchmarks"))


def stored_benchmark(snapshot: DataFrame, name: str) -> DataFrame:
    """One benchmark, stored once for each version of its tables."""
    return materialize_once(benchmark(snapshot, name), f"benchmark-{name}")


def benchmarks(snapshot: DataFrame) -> dict[str, DataFrame]:
    """Four benchmark frames of one grouping-sets aggregation (lazy)."""
    return _split(all_benchmarks(snapshot))
