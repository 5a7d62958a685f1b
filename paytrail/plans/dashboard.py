"""Company, department and title level dashboards over the current snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytrail.functions.numeric import round_half_even, round_half_up, share_pct
from paytrail.operators.quantiles import exact_quantiles, value_counts

LEVELS = {
    # level -> (extra grouping column, tenure column, output tenure name)
    "company": (None, "company_tenure_years", "company_tenure"),
    "department": ("department", "department_tenure_years", "department_tenure"),
    "title": ("title", "title_tenure_years", "title_tenure"),
}


QUARTILES = {"p25_salary": 0.25, "median_salary": 0.5, "p75_salary": 0.75}


def level_dashboard(snapshot: DataFrame, level: str) -> DataFrame:
    """One row per gender (and department or title).  Rows are first combined per
    (group, salary), which spreads a large group over its salaries; statistics and
    quartiles both come from these counts."""
    extra, tenure_col, tenure_name = LEVELS[level]
    keys = ["gender"] + ([extra] if extra else [])
    pct = F.col("salary_percentage_change").cast("decimal(18,2)")
    counts = value_counts(snapshot, keys, "salary", {
        "tenure": F.sum(tenure_col), "tenure_n": F.count(tenure_col), "pct": F.sum(pct), "pct_n": F.count(pct)})
    s, n = F.col("salary").cast("decimal(19,0)"), F.col("__n")
    known = F.when(F.col("salary").isNotNull(), n)
    agg = exact_quantiles(counts, keys, "salary", QUARTILES, [
        F.sum("__n").alias("employee_count"), F.sum(known).alias("salary_n"),
        F.sum("tenure").alias("tenure"), F.sum("tenure_n").alias("tenure_n"),
        F.sum("pct").alias("pct"), F.sum("pct_n").alias("pct_n"), F.min("salary").alias("low"), F.max("salary").alias("high"),
        F.sum((s * known).cast("decimal(38,0)")).alias("total"),
        F.sum((s * s * known).cast("decimal(38,0)")).alias("squares")])
    # Exact sums of integers: the order of rows cannot change a rounding.
    size = F.nullif(F.col("salary_n"), F.lit(0)).cast("double")
    mean = F.col("total").cast("double") / size
    spread = (F.col("squares") * F.col("salary_n") - F.col("total") * F.col("total")).cast("double")
    deviation = F.when(F.col("salary_n") > 1, F.sqrt(spread / (size * (size - 1))))
    # The share window runs over the aggregated rows only (a handful per group).
    w = Window.partitionBy(*([extra] if extra else []))
    share = share_pct(F.col("employee_count"), F.sum("employee_count").over(w))
    return agg.select(
        *keys, "employee_count", share.alias("employee_percentage"),
        round_half_even(F.col("tenure") / F.nullif(F.col("tenure_n"), F.lit(0))).alias(tenure_name),
        round_half_up(mean).alias("avg_salary"),
        round_half_up(F.col("pct").cast("double") / F.nullif(F.col("pct_n"), F.lit(0))).alias("avg_salary_percentage_change"),
        F.col("low").cast("double").alias("min_salary"), F.col("high").cast("double").alias("max_salary"),
        round_half_even(F.col("median_salary")).alias("median_salary"),
        round_half_even(F.col("p75_salary") - F.col("p25_salary")).alias("inter_quartile_range"),
        round_half_up(deviation).alias("stddev_salary"))


def gender_share(snapshot: DataFrame, level: str) -> DataFrame:
    extra = LEVELS[level][0]
    keys = ["gender"] + ([extra] if extra else [])
    w = Window.partitionBy(*([extra] if extra else []))
    return (snapshot.groupBy(*keys).agg(F.count(F.lit(1)).alias("employee_count"))
            .select(*keys, "employee_count",
                    share_pct(F.col("employee_count"), F.sum("employee_count").over(w))
                    .alias("employee_percentage")))


def salary_percentiles(snapshot: DataFrame) -> DataFrame:
    """Unrounded exact median and interquartile range of salary per gender."""
    q = exact_quantiles(value_counts(snapshot, ["gender"], "salary"), ["gender"], "salary", QUARTILES)
    return q.select("gender", "median_salary", "p25_salary", "p75_salary",
                    (F.col("p75_salary") - F.col("p25_salary")).alias("inter_quartile_range"))
