"""Workforce tables derived from the driver's order tables.

The six raw tables (dates before the +18 year repair) are built from
``customer``, ``orders`` and ``nation`` by fixed rules, so their size grows with
the input.  Employees are customers with orders, every order day is a salary
period, every fourth order day starts a new title, some employees move to the
next department after their third order day, every fifth employee has left.
The modulo rules assign dates and departments; they never drop input rows
(every customer with orders becomes an employee, every order day a salary
period, every fourth order day of a person a title change).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.config import HEAVY_ROWS, OPEN_END
from paytrail.operators.sequence import ordered_sequence
from paytrail.operators.slices import heavy_keys

# Fixed values of the fixture rules.
BIRTH_BASE = dt.date(1950, 1, 1)
BIRTH_SPREAD_DAYS = 9000
LEAVER_EVERY = 5
MOVER_EVERY = 3
TITLE_EVERY = 4
DEPARTMENTS = 25
MANAGER_START = dt.date(1990, 1, 1)
MANAGER_HANDOVER = dt.date(1998, 6, 1)

DRIVER_TABLES = ("customer", "orders", "nation")


def read_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in DRIVER_TABLES}


def derive_raw(src: dict[str, DataFrame], rows: int | None = HEAVY_ROWS,
               materialize: Callable[[DataFrame], DataFrame] | None = None
               ) -> dict[str, DataFrame]:
    """The six raw tables.  ``materialize`` (e.g. ``DataFrame.checkpoint``) is
    applied to the two intermediates every table is built from, so that
    writing the six tables does not re-derive them from the orders six times."""
    customer, orders, nation = src["customer"], src["orders"], src["nation"]
    keep = materialize or (lambda df: df)

    # One row per employee and order day (partial aggregation on a
    # (customer, day) key: a busy customer spreads over its days).
    ev = (orders
          .select(F.col("o_custkey").alias("employee_id"),
                  F.col("o_orderdate").cast("date").alias("d"),
                  F.floor("o_totalprice").cast("int").alias("amount"),
                  F.col("o_orderpriority").alias("title"))
          .groupBy("employee_id", "d")
          .agg(F.max("amount").alias("amount"), F.min("title").alias("title")))
    heavy = heavy_keys([(orders, ["o_custkey"], "o_orderdate")], rows)
    ev = keep(ordered_sequence(ev, ["employee_id"], ["d"], leads={"nd": "d"}, number="rn",
                               heavy=heavy))

    emp_end = (ev.groupBy("employee_id")
               .agg(F.min("d").alias("hire"),
                    F.max(F.when(F.col("rn") == 3, F.col("d"))).alias("d3"),
                    F.max("d").alias("last_d"))
               .select("employee_id", "hire", "d3",
                       F.when(F.col("employee_id") % LEAVER_EVERY == 0,
                              F.date_add("last_d", 365))
                       .otherwise(F.lit(OPEN_END)).alias("e")))
    emp_end = keep(emp_end)

    salary = (ev.join(emp_end.select("employee_id", "e"), "employee_id")
              .select("employee_id", "amount", F.col("d").alias("from_date"),
                      F.coalesce("nd", "e").alias("to_date")))

    starts = ev.filter((F.col("rn") - 1) % TITLE_EVERY == 0).select("employee_id", "title", "d")
    starts = ordered_sequence(starts, ["employee_id"], ["d"], leads={"nt": "d"},
                              heavy=heavy)
    title = (starts.join(emp_end.select("employee_id", "e"), "employee_id")
             .select("employee_id", "title", F.col("d").alias("from_date"),
                     F.coalesce("nt", "e").alias("to_date")))

    emp = customer.join(emp_end, customer.c_custkey == emp_end.employee_id)
    employee = emp.select(
        F.col("c_custkey").cast("long").alias("id"),
        F.date_add(F.lit(BIRTH_BASE), (F.col("c_custkey") * 7 % BIRTH_SPREAD_DAYS).cast("int"))
        .alias("birth_date"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_custkey") % 7 < 4, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.col("hire").alias("hire_date"))

    mover = (F.col("employee_id") % MOVER_EVERY == 0) & F.col("d3").isNotNull()
    first_dept = emp.select(
        "employee_id", F.col("c_nationkey").cast("long").alias("department_id"),
        F.col("hire").alias("from_date"),
        F.when(mover, F.col("d3")).otherwise(F.col("e")).alias("to_date"))
    second_dept = emp.filter(mover).select(
        "employee_id", ((F.col("c_nationkey") + 1) % DEPARTMENTS).cast("long").alias("department_id"),
        F.col("d3").alias("from_date"), F.col("e").alias("to_date"))
    department_employee = first_dept.unionByName(second_dept)

    heads = emp.groupBy("c_nationkey").agg(F.min("c_custkey").alias("lo"),
                                          F.max("c_custkey").alias("hi"))
    department_manager = heads.select(
        F.col("lo").cast("long").alias("employee_id"),
        F.col("c_nationkey").cast("long").alias("department_id"),
        F.lit(MANAGER_START).alias("from_date"), F.lit(MANAGER_HANDOVER).alias("to_date"),
    ).unionByName(heads.select(
        F.col("hi").cast("long").alias("employee_id"),
        F.col("c_nationkey").cast("long").alias("department_id"),
        F.lit(MANAGER_HANDOVER).alias("from_date"), F.lit(OPEN_END).alias("to_date")))

    department = nation.select(F.col("n_nationkey").cast("long").alias("id"),
                               F.col("n_name").alias("dept_name"))

    return {
        "employee": employee,
        "title": title,
        "salary": salary,
        "department_employee": department_employee,
        "department_manager": department_manager,
        "department": department,
    }
