"""Current employee snapshot: one row per active employee (per combination of
open records, nothing is de-duplicated)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.config import AS_OF_DEFAULT
from paytrail.functions.dates import year_diff
from paytrail.functions.numeric import full_name, pct_change
from paytrail.operators.joins import beside, materialize_once
from paytrail.operators.scd import current
from paytrail.operators.sequence import heavy_sequence, ordered_sequence
from paytrail.operators.slices import heavy_keys
from paytrail.operators.tables import Tables, unite


_SALARY_ORDER = ["from_date", "to_date", "amount"]


def salary_with_previous(salary: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Every salary record with the amount of the record before it
    (``LAG(amount) OVER (PARTITION BY employee_id ORDER BY from_date)``;
    ``to_date`` breaks ties of equal start dates); ``heavy`` are the heavy employees,
    counted here if not given."""
    if heavy is None:
        heavy = heavy_keys([(salary, ["employee_id"], "from_date")])
    return ordered_sequence(salary, ["employee_id"], _SALARY_ORDER,
                            lags={"previous_salary": "amount"}, heavy=heavy)


def salary_steps(t: Tables) -> DataFrame:
    """:func:`salary_with_previous` of one part of the tables."""
    if t.heavy is None:
        return ordered_sequence(t["salary"], ["employee_id"], _SALARY_ORDER, lags={"previous_salary": "amount"})
    return heavy_sequence(t["salary"], ["employee_id"], _SALARY_ORDER, t.heavy, lags={"previous_salary": "amount"})


def previous_salary_current(salary: DataFrame) -> DataFrame:
    """Previous amount of every open salary record (LAG before the filter)."""
    return current(salary_with_previous(salary)).select("employee_id", "to_date", "previous_salary")


def manager_periods(t: dict[str, DataFrame]) -> DataFrame:
    """Department manager periods with the manager's name (inner join on the
    manager's employee row)."""
    dm = t["department_manager"]
    mgr = t["employee"].select(F.col("id").alias("manager_id"),
                               full_name("first_name", "last_name").alias("manager"))
    return (dm.select("department_id", F.col("employee_id").alias("manager_id"),
                      F.col("from_date").alias("manager_from_date"),
                      F.col("to_date").alias("manager_to_date"))
            .join(mgr, "manager_id"))


def stored_manager_periods(t: dict[str, DataFrame]) -> DataFrame:
    """Manager periods with names, stored once for each version of their tables."""
    return materialize_once(manager_periods(t), "managers")


def _joined(t: Tables, with_manager: bool, managers: DataFrame | None) -> DataFrame:
    emp = t["employee"].select(F.col("id").alias("employee_id"), "gender", "hire_date",
                               "first_name", "last_name")
    title = t.open_rows("title").select("employee_id", "title",
                                        F.col("from_date").alias("title_from_date"))
    sal = t.open_rows("salary").select("employee_id", F.col("amount").alias("salary"))
    prev = current(salary_steps(t)).select("employee_id", "previous_salary")
    dept_emp = t.open_rows("department_employee").select(
        "employee_id", "department_id", F.col("from_date").alias("department_from_date"))
    dept = t["department"].select(F.col("id").alias("department_id"),
                                  F.col("dept_name").alias("department"))
    # Clustered tables meet on employee_id; the others are set beside them.
    j = (emp.join(title, "employee_id").join(sal, "employee_id").join(prev, "employee_id")
         .join(dept_emp, "employee_id").join(beside(dept), "department_id"))
    if with_manager:
        mgr = current(managers, "manager_to_date").select("department_id", "manager")
        j = j.join(beside(mgr), "department_id")
    return j


def current_snapshot(t: dict[str, DataFrame], as_of: dt.date = AS_OF_DEFAULT,
                     with_manager: bool = True, keep_previous: bool = False) -> DataFrame:
    """``with_manager=True`` is the effective definition (with employee and
    manager names, inner join on the current manager); ``False`` the first.
    ``keep_previous`` appends the previous salary amount."""
    managers = stored_manager_periods(t) if with_manager else None
    j = unite([_joined(part, with_manager, managers) for part in Tables.of(t).parts])
    cols = [
        "employee_id", "gender", "title", "salary", "department",
        pct_change("salary", "previous_salary").alias("salary_percentage_change"),
        year_diff(as_of, "hire_date").alias("company_tenure_years"),
        year_diff(as_of, "title_from_date").alias("title_tenure_years"),
        year_diff(as_of, "department_from_date").alias("department_tenure_years"),
    ]
    if with_manager:
        cols += [full_name("first_name", "last_name").alias("employee_name"), "manager"]
    if keep_previous:
        cols.append("previous_salary")
    return j.select(*cols)
