"""
layer 3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paytrail.plans import dashboard, history
from paytrail.plans.snapshot import current_snapshot
from paytrail.sources.staging import warehouse

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2020, 12, 31)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


@pytest.fixture(scope="module")
def t(spark):
    return warehouse(spark, SF).staged()


def test_deep_dive_keeps_at_most_five_rows_per_employee(t):
    deep = history.employee_deep_dive(t, AS_OF)
    assert deep.groupBy("employee_id").count().agg(F.max("count")).first()[0] <= 5
    assert deep.filter(F.col("event_order") > 5).count() == 0


def test_shares_of_each_department_sum_to_100(t):
    snap = current_snapshot(t, AS_OF)
    sums = dashboard.gender_share(snap, "department").groupBy("department") \
        .agg(F.sum("employee_percentage").alias("s")).collect()
    assert sums and all(99 <= r.s <= 101 for r in sums)


def test_half_open_periods_of_an_employee_do_not_overlap(t):
    p = history.history_periods(t, bounds="half_open")
    w = Window.partitionBy("employee_id").orderBy("effective_date", "expiry_date")
    nxt = p.withColumn("next_eff", F.lead("effective_date").over(w))
    assert nxt.filter(F.col("next_eff") < F.col("expiry_date")).count() == 0


def test_input_partitioning_does_not_change_the_history(t):
    base = history.with_events(history.history_base(t, AS_OF))
    shuffled = {k: v.repartition(7) for k, v in t.items()}
    other = history.with_events(history.history_base(shuffled, AS_OF))
    cols = ["employee_id", "event_order", "effective_date", "expiry_date", "title", "salary",
            "manager", "event_name", "previous_salary"]
    assert base.select(*cols).exceptAll(other.select(*cols)).count() == 0
    assert base.count() == other.count()
