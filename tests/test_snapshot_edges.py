
import datetime as dt

from paytrail.plans.benchmark import benchmarks
from paytrail.plans.dashboard import level_dashboard
from paytrail.plans.snapshot import current_snapshot
from tables import frames

AS_OF = dt.date(2020, 12, 31)


def _base(**over):
    t = dict(
        employee=[(1, "1980-01-01", "A", "One", "M", "2015-06-01"),
                  (2, "1981-01-01", "B", "Two", "F", "2016-06-01"),
                  (3, "1982-01-01", "C", "Three", "F", "2017-06-01"),
                  (9, "1960-01-01", "Max", "Boss", "M", "2000-01-01")],
        title=[(1, "Eng", "2015-06-01", "9999-01-01"), (2, "Eng", "2016-06-01", "9999-01-01"),
               (3, "Ops", "2017-06-01", "2019-01-01")],
        salary=[(1, 100, "2015-06-01", "2016-06-01"), (1, 110, "2016-06-01", "9999-01-01"),
                (2, 0, "2016-06-01", "2017-06-01"), (2, 50, "2017-06-01", "9999-01-01"),
                (3, 70, "2017-06-01", "2019-01-01")],
        department_employee=[(1, 1, "2015-06-01", "9999-01-01"), (2, 1, "2016-06-01", "9999-01-01"),
                             (3, 2, "2017-06-01", "2019-01-01")],
        department_manager=[(9, 1, "2010-01-01", "9999-01-01")],
        department=[(1, "Dev"), (2, "Ops")],
    )
    t.update(over)
    return t


def test_former_employee_and_zero_previous_salary(spark):
    snap = current_snapshot(frames(spark, **_base()), AS_OF).orderBy("employee_id").collect()
    assert [r.employee_id for r in snap] == [1, 2]           # 3 has left
    assert snap[0].salary_percentage_change == 10.0
    assert snap[1].salary_percentage_change is None         # previous salary 0 -> NULL
    assert snap[0].manager == "Max Boss" and snap[0].employee_name == "A One"


def test_first_record_has_null_previous_salary(spark):
    t = _base(salary=[(1, 100, "2015-06-01", "9999-01-01"), (2, 50, "2017-06-01", "9999-01-01")])
    snap = current_snapshot(frames(spark, **t), AS_OF)
    assert {r.employee_id: r.salary_percentage_change for r in snap.collect()} == {1: None, 2: None}


def test_department_without_current_manager_vanishes(spark):
    t = _base(department_manager=[(9, 1, "2010-01-01", "2019-01-01")])
    assert current_snapshot(frames(spark, **t), AS_OF).count() == 0
    assert current_snapshot(frames(spark, **t), AS_OF, with_manager=False).count() == 2


def test_two_current_managers_double_rows(spark):
    t = _base(department_manager=[(9, 1, "2010-01-01", "9999-01-01"),
                                  (3, 1, "2018-01-01", "9999-01-01")])
    assert current_snapshot(frames(spark, **t), AS_OF).count() == 4


def test_two_open_salaries_give_the_product(spark):
    t = _base()
    t["salary"] = t["salary"] + [(1, 120, "2017-01-01", "9999-01-01")]
    snap = current_snapshot(frames(spark, **t), AS_OF)
    assert snap.filter("employee_id = 1").count() == 4


def test_single_row_group_has_null_stddev_and_shares_sum(spark):
    snap = current_snapshot(frames(spark, **_base()), AS_OF)
    dash = {r.gender: r for r in level_dashboard(snap, "company").collect()}
    assert dash["M"].employee_count == 1 and dash["M"].stddev_salary is None
    assert dash["M"].employee_percentage + dash["F"].employee_percentage == 100
    assert dash["F"].median_salary == 50.0


def test_benchmarks_cover_each_value_once(spark):
    snap = current_snapshot(frames(spark, **_base()), AS_OF)
    bm = benchmarks(snap)
    assert {r.gender: r.gender_benchmark_salary for r in bm["gender"].collect()} == \
        {"M": 110.0, "F": 50.0}
    assert {r.title: r.title_benchmark_salary for r in bm["title"].collect()} == {"Eng": 80.0}
    assert bm["tenure"].count() == 2 and bm["department"].count() == 1
