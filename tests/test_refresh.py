"""The stored history after a change of its tables equals a full run."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paytrail.plans import history
from paytrail.plans.refresh import StoredHistory, changed, digests
from tables import D, golden

TABLES = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def equal(store, t):
    assert rows(store.read()) == rows(history.lagged_periods(t))


def test_only_buckets_of_changed_employees_are_written(spark, tmp_path):
    from paytrail.sources.staging import warehouse
    t = dict(warehouse(spark, TABLES).staged())
    store = StoredHistory(spark, str(tmp_path), buckets=64)
    with pytest.raises(ValueError):
        store.read()
    first = store.refresh(t)
    assert first.version == 1 and first.employees == t["salary"].select("employee_id").distinct().count()
    equal(store, t)
    assert store.refresh(t) == store.refresh(t) and store.version() == 1

    ids = [r[0] for r in t["salary"].select("employee_id").distinct().orderBy("employee_id").limit(2).collect()]
    t2 = {**t, "salary": t["salary"].withColumn("amount", F.when(F.col("employee_id").isin(ids), F.col("amount") + 7)
                                                .otherwise(F.col("amount")))}
    second = store.refresh(t2)
    assert second.employees == 2 and 1 <= len(second.buckets) <= 2
    equal(store, t2)
    again = {p.name for p in (tmp_path / "closed-64" / f"v{second.version:06d}" / "periods").iterdir() if p.is_dir()}
    assert again <= {f"bucket={b}" for b in second.buckets}

    gone = {**t2, **{n: t2[n].where(F.col("employee_id") != ids[0]) for n in ("title", "salary", "department_employee")}}
    assert store.refresh(gone).employees == 1
    equal(store, gone)


def test_a_new_manager_reaches_the_employees_of_the_department(spark, tmp_path):
    t = golden(spark)
    store = StoredHistory(spark, str(tmp_path), buckets=4)
    store.refresh(t)
    t = {**t, "department_manager": spark.createDataFrame(
        [(10, 5, D("2017-01-01"), dt.date(9999, 1, 1))], t["department_manager"].schema)}
    assert store.refresh(t).employees == 1
    equal(store, t)
    assert {r.manager for r in store.read().collect()} == {"Ann Lee"}
    t = {**t, "department": spark.createDataFrame([(5, "Studies")], t["department"].schema)}
    store.refresh(t)
    assert {r.department for r in store.read().collect()} == {"Studies"}


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    t = golden(spark)
    store = StoredHistory(spark, str(tmp_path), buckets=4)
    store.refresh(t)
    spark.range(1).write.parquet(f"{store.root}/v000002/periods/bucket=0")
    equal(store, t)
    none = {**t, **{n: t[n].limit(0) for n in ("title", "salary", "department_employee")}}
    assert store.refresh(none).version == 3
    assert store.read().count() == 0


def test_digests_see_nulls_and_repeats_but_no_order(spark):
    def of(*values):
        return digests({"t": (spark.createDataFrame([(1, *v) for v in values], "k long, a string, b string"), "k")})

    def differ(x, y):
        return changed(of(*x), of(*y)).count() == 1

    a, b = ("x", None), (None, "x")
    assert not differ([a, b], [b, a])
    assert differ([a], [b]) and differ([a], [a, a]) and differ([a, a, b], [a, b, b])
