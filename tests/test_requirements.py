"""Months per position / department and the average pay rise, by hand."""

import datetime as dt

from paytrail.plans import requirements
from tables import frames

AS_OF = dt.date(2020, 12, 31)


def test_months_in_title_are_capped_at_as_of(spark):
    t = frames(spark,
               title=[(1, "A", "2019-02-28", "2020-03-27"), (1, "B", "2020-03-27", "9999-01-01"),
                      (2, "C", "2021-06-01", "9999-01-01")],
               department=[(1, "D")],
               department_employee=[(1, 1, "2018-01-15", "9999-01-01")])
    got = {r.title: r.months_in_title for r in requirements.title_months(t, AS_OF).collect()}
    assert got == {"A": 12, "B": 9, "C": 0}  # 13 months minus a day; to as_of; future
    dep = requirements.department_months(t, AS_OF).first()
    assert (dep.department, dep.months_in_department) == ("D", 35)


def test_average_payrise(spark):
    snap = spark.createDataFrame(
        [("F", 110, 100, 10.0), ("F", 50, 40, 25.0), ("M", 70, None, None)],
        "gender string, salary int, previous_salary int, salary_percentage_change double")
    got = {r.gender: (r.employee_count, r.avg_payrise_amount, r.avg_payrise_percentage)
           for r in requirements.average_payrise(snap).collect()}
    assert got == {"F": (2, 10.0, 17.5), "M": (1, None, None)}
