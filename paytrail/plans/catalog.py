"""Named queries: one per operator / view of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame (those with managers or
benchmarks write these small tables while the plan is built) over the
warehouse built from that input folder (raw and staged copies stored once).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.config import AS_OF_DEFAULT, checkpoint_root
from paytrail.functions.dates import age_months_field, year_diff
from paytrail.functions.numeric import full_name, pct_change
from paytrail.operators import profile
from paytrail.operators.joins import beside
from paytrail.operators.scd import current
from paytrail.operators.tables import FACTS, Tables, unite
from paytrail.plans import dashboard, history, requirements, sketched
from paytrail.plans.benchmark import benchmark, stored_benchmark
from paytrail.plans.refresh import StoredHistory
from paytrail.plans.snapshot import current_snapshot, manager_periods, salary_steps
from paytrail.sources.schemas import PERSON_KEYS, UNIQUE_KEYS
from paytrail.sources.staging import stage_table, warehouse

Query = Callable[[SparkSession, str], DataFrame]
_RUN_DATE: ContextVar[dt.date] = ContextVar("run_date", default=AS_OF_DEFAULT)


def as_of() -> dt.date:
    """The run date of the query that is being built."""
    return _RUN_DATE.get()


def staged(spark: SparkSession, sf_dir: str) -> Tables:
    return warehouse(spark, sf_dir).staged()


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return warehouse(spark, sf_dir).raw()


def _snap(spark, sf_dir, with_manager=True):
    return current_snapshot(staged(spark, sf_dir), as_of(), with_manager)


# ---- staging -------------------------------------------------------------

def preview_employee(spark, sf_dir):
    return raw(spark, sf_dir)["employee"].orderBy("id").limit(5)


def _preview(name):
    """Five rows of a raw table; ordered by every column so that the five are
    always the same ones (the original's unordered LIMIT picks any five)."""
    def q(spark, sf_dir):
        df = raw(spark, sf_dir)[name]
        return df.orderBy(*df.columns).limit(5)
    return q


def _stage(name):
    def q(spark, sf_dir):
        return stage_table(name, raw(spark, sf_dir)[name])
    q.__name__ = f"stage_{name}"
    return q


# ---- profiling -----------------------------------------------------------

# Output names as in the original views (spelling included).
def records_per_employee_employee(spark, sf_dir):
    return profile.records_per_key(raw(spark, sf_dir)["employee"], "id",
                                   out="number_of_emp_with_record_value")


def records_per_employee_title(spark, sf_dir):
    return profile.records_per_key(raw(spark, sf_dir)["title"], "employee_id", "employee_id")


def records_per_employee_salary(spark, sf_dir):
    return profile.records_per_key(raw(spark, sf_dir)["salary"], "employee_id")


def records_per_employee_department(spark, sf_dir):
    return profile.records_per_key(raw(spark, sf_dir)["department_employee"], "employee_id",
                                   out="employess_with_record_value")


def records_per_employee_manager(spark, sf_dir):
    return profile.records_per_key(raw(spark, sf_dir)["department_manager"], "employee_id",
                                   "department_id")


def managers_per_department(spark, sf_dir):
    return profile.records_per_key(raw(spark, sf_dir)["department_manager"], "department_id",
                                   "employee_id", distinct=True,
                                   out="departments_with_record_value")


def distinct_employees(spark, sf_dir):
    return profile.distinct_count(raw(spark, sf_dir)["employee"], "id", "employee_count")


def distinct_employees_salary(spark, sf_dir):
    return profile.distinct_count(staged(spark, sf_dir)["salary"], "employee_id")


def distinct_employees_title(spark, sf_dir):
    return profile.distinct_count(staged(spark, sf_dir)["title"], "employee_id")


def distinct_employees_department(spark, sf_dir):
    return profile.distinct_count(staged(spark, sf_dir)["department_employee"], "employee_id")


def _latest(name):
    def q(spark, sf_dir):
        return profile.latest_dates(staged(spark, sf_dir)[name])
    return q


def departments_sorted(spark, sf_dir):
    return raw(spark, sf_dir)["department"].orderBy("id")


def former_employee_records(spark, sf_dir):
    return profile.former_records(raw(spark, sf_dir)["salary"])


# ---- quality -------------------------------------------------------------

def key_violations(spark, sf_dir):
    return profile.key_violations(staged(spark, sf_dir), UNIQUE_KEYS)


def repeated_person_keys(spark, sf_dir):
    return profile.key_violations(staged(spark, sf_dir), PERSON_KEYS)


def relationship_types(spark, sf_dir):
    r = raw(spark, sf_dir)
    parts = [
        profile.relationship(r["employee"], "employee", "id"),
        profile.relationship(r["title"], "title", "employee_id", "employee_id"),
        profile.relationship(r["salary"], "salary", "employee_id"),
        profile.relationship(r["department_employee"], "department_employee", "employee_id"),
        profile.relationship(r["department_manager"], "department_manager", "employee_id",
                             "department_id"),
        profile.relationship(r["department_manager"], "department_manager", "department_id",
                             "employee_id", distinct=True),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile_counts(spark, sf_dir):
    return profile.reconcile_counts(staged(spark, sf_dir), _snap(spark, sf_dir))


def snapshot_row_count(spark, sf_dir):
    return _snap(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


# ---- building blocks -----------------------------------------------------

def current_records(spark, sf_dir):
    return current(staged(spark, sf_dir)["salary"])


def q_previous_salary_current(spark, sf_dir):
    t = staged(spark, sf_dir)
    return unite([current(salary_steps(part)) for part in t.parts]).select("employee_id", "to_date", "previous_salary")


def previous_salary_latest(spark, sf_dir):
    return history.previous_latest_salary(staged(spark, sf_dir))


def _employees(t):
    return t["employee"].select(F.col("id").alias("employee_id"), "gender", "hire_date")


def join_employee_title(spark, sf_dir):
    t = staged(spark, sf_dir)
    return _employees(t).join(
        t.open_rows("title").select("employee_id", "title", F.col("from_date").alias("title_from_date")),
        "employee_id")


def join_employee_salary(spark, sf_dir):
    t = staged(spark, sf_dir)
    return _employees(t).select("employee_id", "gender").join(
        t.open_rows("salary").select("employee_id", F.col("amount").alias("salary")), "employee_id")


def join_employee_department(spark, sf_dir):
    t = staged(spark, sf_dir)
    dept = t["department"].select(F.col("id").alias("department_id"),
                                  F.col("dept_name").alias("department"))
    return (_employees(t).select("employee_id", "gender")
            .join(t.open_rows("department_employee").select(
                "employee_id", "department_id", F.col("from_date").alias("department_from_date")),
                "employee_id")
            .join(beside(dept), "department_id")
            .select("employee_id", "gender", "department_id", "department", "department_from_date"))


def department_managers(spark, sf_dir):
    t = staged(spark, sf_dir)
    dept = t["department"].select(F.col("id").alias("department_id"),
                                  F.col("dept_name").alias("department"))
    return dept.join(manager_periods(t), "department_id").select(
        "department_id", "department", "manager_id", "manager", "manager_from_date",
        "manager_to_date")


def tenure_years(spark, sf_dir):
    e = staged(spark, sf_dir)["employee"]
    return e.select(F.col("id").alias("employee_id"), "hire_date",
                    year_diff(as_of(), "hire_date").alias("company_tenure_years"))


def employee_age(spark, sf_dir):
    e = staged(spark, sf_dir)["employee"]
    return e.select(F.col("id").alias("employee_id"), "birth_date",
                    year_diff(as_of(), "birth_date").alias("employee_age"))


def title_tenure_months(spark, sf_dir):
    t = staged(spark, sf_dir)["title"]
    return t.select("employee_id", "title", "from_date",
                    age_months_field(as_of(), "from_date").alias("title_tenure_months"))


def employee_names(spark, sf_dir):
    e = staged(spark, sf_dir)["employee"]
    return e.select(F.col("id").alias("employee_id"),
                    full_name("first_name", "last_name").alias("employee_name"))


def salary_change(spark, sf_dir):
    s = unite([salary_steps(part) for part in staged(spark, sf_dir).parts])
    return s.select("employee_id", "from_date", "to_date", F.col("amount").alias("salary"),
                    "previous_salary",
                    (F.col("amount") - F.col("previous_salary")).cast("double")
                    .alias("salary_amount_change"),
                    pct_change("amount", "previous_salary").alias("salary_percentage_change"))


def salary_median(spark, sf_dir):
    return dashboard.salary_percentiles(_snap(spark, sf_dir)).select("gender", "median_salary")


def salary_iqr(spark, sf_dir):
    return dashboard.salary_percentiles(_snap(spark, sf_dir)).select(
        "gender", "p25_salary", "p75_salary", "inter_quartile_range")


def _share(level):
    def q(spark, sf_dir):
        return dashboard.gender_share(_snap(spark, sf_dir), level)
    return q


# ---- snapshot, dashboards, benchmarks ------------------------------------

def current_snapshot_basic(spark, sf_dir):
    return _snap(spark, sf_dir, with_manager=False)


def q_current_snapshot(spark, sf_dir):
    return _snap(spark, sf_dir)


def _dash(level):
    def q(spark, sf_dir):
        return dashboard.level_dashboard(_snap(spark, sf_dir), level)
    return q


def _bench(name):
    def q(spark, sf_dir):
        return benchmark(_snap(spark, sf_dir), name)
    return q


# ---- history -------------------------------------------------------------

def history_periods(spark, sf_dir):
    return history.history_periods(staged(spark, sf_dir))


def history_periods_half_open(spark, sf_dir):
    return history.history_periods(staged(spark, sf_dir), bounds="half_open")


def history_lags(spark, sf_dir):
    lagged = history.lagged_periods(staged(spark, sf_dir))
    return lagged.select("employee_id", "effective_date", "expiry_date", "title",
                         "previous_title", "salary", "previous_salary", "department",
                         "previous_department", "manager", "previous_manager", "event_order")


def history_lags_refreshed(spark, sf_dir):
    """The same from a stored history: made from the periods that began over a year
    before the run date, then refreshed with those that came since."""
    t = staged(spark, sf_dir)
    year_ago = F.add_months(F.lit(as_of()), -12)
    store = StoredHistory(spark, f"{checkpoint_root(spark)}/paytrail-steps/history-{uuid.uuid4().hex}")
    store.refresh({**t, **{n: t[n].where(F.col("from_date") < year_ago) for n in FACTS}})
    store.refresh(t)
    return store.read().select("employee_id", "effective_date", "expiry_date", "title",
                               "previous_title", "salary", "previous_salary", "department",
                               "previous_department", "manager", "previous_manager", "event_order")


def _events(spark, sf_dir):
    return history.with_events(history.history_base(staged(spark, sf_dir), as_of()))


def employee_events(spark, sf_dir):
    return _events(spark, sf_dir).select("employee_id", "effective_date", "expiry_date",
                                         "event_order", "event_name")


_VS_KEY = {"tenure": "company_tenure_years", "title": "title", "department": "department",
           "gender": "gender"}


def _vs(name):
    def q(spark, sf_dir):
        bench = stored_benchmark(_snap(spark, sf_dir), name)
        rows = history.compare_to(_events(spark, sf_dir), bench, name)
        return rows.select("employee_id", "event_order", _VS_KEY[name], "salary",
                           f"{history.BENCHMARKS[name][1]}", f"{name}_comparison")
    return q


def historic_employee_records(spark, sf_dir):
    return history.historic_employee_records(staged(spark, sf_dir), as_of())


def employee_deep_dive(spark, sf_dir):
    return history.employee_deep_dive(staged(spark, sf_dir), as_of())


# ---- requirements stated but not computed in the original ----------------

def average_payrise(spark, sf_dir):
    snap = current_snapshot(staged(spark, sf_dir), as_of(), keep_previous=True)
    return requirements.average_payrise(snap)


def title_history_months(spark, sf_dir):
    return requirements.title_months(staged(spark, sf_dir), as_of())


def department_history_months(spark, sf_dir):
    return requirements.department_months(staged(spark, sf_dir), as_of())


# ---- sketches ------------------------------------------------------------

def distinct_sketch_audit(spark, sf_dir):
    return sketched.distinct_audit(staged(spark, sf_dir))


def _quartile_audit(level):
    def q(spark, sf_dir):
        return sketched.quartile_audit(_snap(spark, sf_dir), level)
    return q


QUERIES: dict[str, Query] = {
    "preview_employee": preview_employee,
    **{f"preview_{n}": _preview(n) for n in ("title", "salary", "department_employee",
                                              "department_manager")},
    **{f"stage_{n}": _stage(n) for n in ("department", "department_employee",
                                          "department_manager", "employee", "salary", "title")},
    "records_per_employee_employee": records_per_employee_employee,
    "records_per_employee_title": records_per_employee_title,
    "records_per_employee_salary": records_per_employee_salary,
    "records_per_employee_department": records_per_employee_department,
    "records_per_employee_manager": records_per_employee_manager,
    "managers_per_department": managers_per_department,
    "distinct_employees": distinct_employees,
    "distinct_employees_salary": distinct_employees_salary,
    "distinct_employees_title": distinct_employees_title,
    "distinct_employees_department": distinct_employees_department,
    "latest_to_dates_salary": _latest("salary"),
    "latest_to_dates_department": _latest("department_employee"),
    "latest_to_dates_title": _latest("title"),
    "departments_sorted": departments_sorted,
    "former_employee_records": former_employee_records,
    "key_violations": key_violations,
    "repeated_person_keys": repeated_person_keys,
    "relationship_types": relationship_types,
    "reconcile_counts": reconcile_counts,
    "snapshot_row_count": snapshot_row_count,
    "current_records": current_records,
    "previous_salary_current": q_previous_salary_current,
    "previous_salary_latest": previous_salary_latest,
    "join_employee_title": join_employee_title,
    "join_employee_salary": join_employee_salary,
    "join_employee_department": join_employee_department,
    "department_managers": department_managers,
    "tenure_years": tenure_years,
    "employee_age": employee_age,
    "title_tenure_months": title_tenure_months,
    "employee_names": employee_names,
    "salary_change": salary_change,
    "salary_median": salary_median,
    "salary_iqr": salary_iqr,
    "gender_share_company": _share("company"),
    "gender_share_department": _share("department"),
    "gender_share_title": _share("title"),
    "current_snapshot_basic": current_snapshot_basic,
    "current_snapshot": q_current_snapshot,
    "company_dashboard": _dash("company"),
    "department_dashboard": _dash("department"),
    "title_dashboard": _dash("title"),
    "benchmark_tenure": _bench("tenure"),
    "benchmark_gender": _bench("gender"),
    "benchmark_department": _bench("department"),
    "benchmark_title": _bench("title"),
    "history_periods": history_periods,
    "history_periods_half_open": history_periods_half_open,
    "history_lags": history_lags,
    "history_lags_refreshed": history_lags_refreshed,
    "employee_events": employee_events,
    "history_vs_tenure": _vs("tenure"),
    "history_vs_title": _vs("title"),
    "history_vs_department": _vs("department"),
    "history_vs_gender": _vs("gender"),
    "historic_employee_records": historic_employee_records,
    "employee_deep_dive": employee_deep_dive,
    "average_payrise": average_payrise,
    "title_history_months": title_history_months,
    "department_history_months": department_history_months,
    "distinct_sketch_audit": distinct_sketch_audit,
    **{f"quartile_sketch_audit_{level}": _quartile_audit(level) for level in dashboard.LEVELS},
}


def _at(query: Query, day: dt.date) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        token = _RUN_DATE.set(day)
        try:
            return query(spark, sf_dir)
        finally:
            _RUN_DATE.reset(token)
    return run


def queries(day: dt.date | None = None) -> dict[str, Query]:
    """The named queries, all of them at one run date (default ``AS_OF_DEFAULT``)."""
    return dict(QUERIES) if day is None else {name: _at(query, day) for name, query in QUERIES.items()}
