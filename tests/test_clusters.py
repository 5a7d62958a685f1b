"""Staged facts are clustered by employee: joins and windows on it need no shuffle."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from paytrail.operators.tables import FACTS, Tables
from paytrail.plans import history, snapshot
from paytrail.plans.catalog import QUERIES
from paytrail.sources import staging
from paytrail.sources.staging import read_tables, warehouse
from tables import frames, golden

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2020, 12, 31)


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
@pytest.mark.parametrize("key", ["join_employee_title", "join_employee_salary", "join_employee_department", "salary_change",
                                 "previous_salary_current", "previous_salary_latest", "history_periods", "history_lags",
                                 "employee_events", "current_snapshot", "historic_employee_records", "employee_deep_dive"])
def test_facts_are_not_shuffled(spark, no_broadcast, key):
    plan = _plan(QUERIES[key](spark, SF))
    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan, plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_the_snapshot_reads_the_partition_of_open_rows(spark):
    t = warehouse(spark, SF).staged()
    assert "PartitionFilters: [isnotnull(open" in _plan(t.open_rows("title"))
    for name in FACTS:
        want = t[name].where(F.col("to_date") == F.lit(dt.date(9999, 1, 1)))
        assert sorted(map(repr, t.open_rows(name).collect())) == sorted(map(repr, want.collect()))


def _busy(spark):
    """One employee with many periods, several of them on one day, beside ordinary ones."""
    day = dt.date(2015, 1, 1)
    salary = [(1, 1000 + i, str(day + dt.timedelta(days=i)), str(day + dt.timedelta(days=i + i % 4))) for i in range(60)]
    salary += [(1, 5000, "2016-01-01", "9999-01-01"), (2, 40, "2014-01-01", "9999-01-01"), (None, 3, "2014-01-01", "9999-01-01")]
    title = [(1, f"T{i}", str(day + dt.timedelta(days=5 * (i // 2))), "9999-01-01") for i in range(6)] + [(2, "T", "2014-01-01", "9999-01-01")]
    return frames(spark, employee=[(1, "1990-05-05", "Cy", "Doe", "F", "2014-01-01"), (2, "1990-05-05", "Di", "Roe", "M", "2014-01-01"),
                                   (3, "1980-05-05", "Bo", "Kim", "M", "2010-01-01")],
                  title=title, salary=salary,
                  department_employee=[(1, 5, "2014-01-01", "2015-01-10"), (1, 6, "2015-01-10", "9999-01-01"), (2, 5, "2014-01-01", "9999-01-01")],
                  department_manager=[(3, 5, "2010-01-01", "9999-01-01"), (3, 6, "2010-01-01", "9999-01-01")],
                  department=[(5, "Research"), (6, "Sales")])


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_heavy_employees_are_stored_apart_and_give_the_same_rows(spark, tmp_path, monkeypatch):
    from paytrail.operators import tables
    for name, df in _busy(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
    raw = read_tables(spark, str(tmp_path))
    plain = warehouse(spark, "plain", tables=raw, root=f"{tmp_path}/plain").staged()
    assert len(plain.parts) == 1
    whole = tables.heavy_employees
    monkeypatch.setattr(staging, "heavy_employees", lambda t: whole(t, 20))
    split = warehouse(spark, "split", tables=raw, root=f"{tmp_path}/split").staged()
    assert [p.heavy is None for p in split.parts] == [True, False]
    assert split.parts[0]["salary"].where("employee_id = 1").count() == 0
    assert _rows(split["salary"]) == _rows(plain["salary"])
    assert _rows(snapshot.current_snapshot(split, AS_OF)) == _rows(snapshot.current_snapshot(plain, AS_OF))
    for bounds in ("closed", "half_open"):
        assert _rows(history.history_periods(split, bounds)) == _rows(history.history_periods(plain, bounds))
    assert _rows(history.historic_employee_records(split, AS_OF)) == _rows(history.historic_employee_records(plain, AS_OF))


def test_plain_frames_are_split_by_their_own_count(spark):
    t = golden(spark)
    assert [p.heavy is None for p in Tables.of(t).parts] == [True]
    assert [p.heavy is None for p in Tables.of(t, 2).parts] == [True, False]
    assert _rows(history.history_periods(t, rows=2)) == _rows(history.history_periods(t))
