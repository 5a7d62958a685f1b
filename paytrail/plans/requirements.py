"""Two requirements the original states but never computes: the average pay
rise amount (only its percentage is computed) and the time spent in each
position and department in months, with start and end dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.config import AS_OF_DEFAULT
from paytrail.functions.dates import completed_months
from paytrail.functions.numeric import exact_mean, round_half_up


def average_payrise(snapshot: DataFrame) -> DataFrame:
    """Average pay rise amount and percentage of current employees by gender
    (``snapshot`` built with ``keep_previous=True``)."""
    return snapshot.groupBy("gender").agg(
        F.count(F.lit(1)).alias("employee_count"),
        round_half_up(F.avg(F.col("salary") - F.col("previous_salary")), 2)
        .alias("avg_payrise_amount"),
        round_half_up(exact_mean("salary_percentage_change"), 2).alias("avg_payrise_percentage"))


def months_in_period(start: str, end: str, as_of: dt.date = AS_OF_DEFAULT) -> Column:
    """Whole months of a period, counted up to ``as_of`` at the latest (open
    periods run to ``as_of``); never negative."""
    return F.greatest(completed_months(start, F.least(F.col(end), F.lit(as_of))),
                      F.lit(0)).cast("long")


def title_months(t: dict[str, DataFrame], as_of: dt.date = AS_OF_DEFAULT) -> DataFrame:
    return t["title"].select("employee_id", "title", "from_date", "to_date",
                             months_in_period("from_date", "to_date", as_of)
                             .alias("months_in_title"))


def department_months(t: dict[str, DataFrame], as_of: dt.date = AS_OF_DEFAULT) -> DataFrame:
    dept = t["department"].select(F.col("id").alias("department_id"),
                                  F.col("dept_name").alias("department"))
    return t["department_employee"].join(dept, "department_id").select(
        "employee_id", "department", "from_date", "to_date",
        months_in_period("from_date", "to_date", as_of).alias("months_in_department"))
