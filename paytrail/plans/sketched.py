"""Approximate forms of the distinct counts and salary quartiles, made from sketches,
and their audits against the exact values."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.operators import sketches
from paytrail.operators.joins import materialize
from paytrail.plans.dashboard import LEVELS, QUARTILES

RELATIONS = ("salary", "title", "department_employee")
#: Standard errors (distinct counts) and 99 % bounds (ranks) within which an audit expects an estimate.
DISTINCT_BOUND, RANK_BOUND = 4, 2


def employee_sketches(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(relation, to_date, sketch): the distinct employees of each table and date, stored."""
    return materialize(reduce(DataFrame.unionByName, [
        sketches.distinct_sketches(tables[n], ["to_date"], "employee_id").select(
            F.lit(n).alias("relation"), "to_date", sketches.SKETCH) for n in RELATIONS]), "sketches")


def distinct_employees(made: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct employees for each of ``keys`` (relation, to_date, both or none):
    the dates' sketches united, the tables are not read again."""
    return sketches.united_distinct(made, keys).select(*keys, sketches.distinct_estimate().alias("employee_estimate"))


def distinct_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact distinct employees of each table, and whether the estimate lies within ``DISTINCT_BOUND`` standard errors."""
    exact = reduce(DataFrame.unionByName, [tables[n].agg(
        F.lit(n).alias("relation"), F.countDistinct("employee_id").alias("distinct_employees")) for n in RELATIONS])
    off = F.abs(F.coalesce("employee_estimate", F.lit(0)) - F.col("distinct_employees"))
    return exact.join(distinct_employees(employee_sketches(tables), "relation"), "relation", "left").select(
        "relation", "distinct_employees",
        (off <= DISTINCT_BOUND * sketches.distinct_error() * F.col("distinct_employees")).alias("within_error"))


def salary_sketches(snapshot: DataFrame) -> DataFrame:
    """(gender, department, title, sketch): one pass over the snapshot for all levels, stored."""
    return materialize(sketches.quantile_sketches(snapshot, ["gender", "department", "title"], "salary"), "sketches")


def salary_quartiles(made: DataFrame, level: str) -> DataFrame:
    """Approximate quartiles of salary per gender and department or title."""
    keys = ["gender", *([LEVELS[level][0]] if LEVELS[level][0] else [])]
    return sketches.united_quantiles(made, keys).select(*keys, *sketches.quantile_columns(QUARTILES))


def quartile_audit(snapshot: DataFrame, level: str) -> DataFrame:
    """For each group and quartile the rows with a salary, and whether the rank of the estimate lies
    within ``RANK_BOUND`` times the rank error; an equal salary takes all of its ranks."""
    keys = ["gender", *([LEVELS[level][0]] if LEVELS[level][0] else [])]
    quartiles = salary_quartiles(salary_sketches(snapshot), level)
    far = RANK_BOUND * sketches.rank_error()
    same = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys])
    # Rows are combined per salary first; the quartiles are one row for each group.
    counts = snapshot.groupBy(*keys, "salary").agg(F.count("salary").alias("n"))
    of = counts.alias("s").join(quartiles.alias("q"), same).groupBy(*[F.col(f"q.{k}").alias(k) for k in keys])
    sums = of.agg(F.sum("n").alias("salary_count"), *[c for name in QUARTILES for c in (
        F.sum(F.when(F.col("salary") < F.col(name), F.col("n")).otherwise(0)).alias(f"{name}_below"),
        F.sum(F.when(F.col("salary") <= F.col(name), F.col("n")).otherwise(0)).alias(f"{name}_upto"))])
    n = F.col("salary_count")
    return sums.select(*keys, "salary_count", *[
        ((n == 0) | ((F.col(f"{name}_below") <= (p + far) * n) & (F.col(f"{name}_upto") >= (p - far) * n))).alias(f"{name}_within_error")
        for name, p in QUARTILES.items()])
