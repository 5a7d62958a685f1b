"""Stored results follow their input: a table written over gives new answers."""

import datetime as dt

from paytrail.operators.joins import _KNOWN, MOST_KNOWN, materialize_once, remembered
from paytrail.operators.versions import LISTED_FILES, folder_version, frame_version, stored_bytes
from paytrail.plans import catalog, history, snapshot
from paytrail.plans.catalog import QUERIES
from paytrail.sources.staging import read_tables, warehouse
from tables import frames, golden

AS_OF = dt.date(2020, 12, 31)


def test_versions_see_paths_lengths_and_times(spark, tmp_path):
    path = f"{tmp_path}/a b"
    spark.range(5).write.parquet(path)
    first, folder = frame_version(spark.read.parquet(path)), folder_version(spark, [path])
    assert frame_version(spark.read.parquet(path)) == first
    assert frame_version(spark.read.parquet(path).where("id > 2")) == first
    assert stored_bytes(spark.read.parquet(path)) > 0 and stored_bytes(spark.range(3)) is None
    spark.range(6).write.mode("overwrite").parquet(path)
    assert frame_version(spark.read.parquet(path)) != first and folder_version(spark, [path]) != folder
    assert folder_version(spark, [f"{tmp_path}/none"]) == folder_version(spark, [])


def test_many_files_are_listed_by_a_job(spark, tmp_path, monkeypatch):
    from paytrail.operators import versions
    path = f"{tmp_path}/t"
    spark.range(9).repartition(3).write.parquet(path)
    monkeypatch.setattr(versions, "LISTED_FILES", 1)
    first = frame_version(spark.read.parquet(path))
    assert frame_version(spark.read.parquet(path)) == first
    spark.range(9).repartition(3).write.mode("overwrite").parquet(path)
    assert frame_version(spark.read.parquet(path)) != first
    assert LISTED_FILES > 1


def test_a_stored_result_is_made_anew_for_new_files(spark, tmp_path):
    path = f"{tmp_path}/t"

    def write(v):
        spark.createDataFrame([(v,)], "v int").write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    assert materialize_once(write(1)).collect()[0].v == 1
    again = write(2)
    assert materialize_once(again).collect()[0].v == 2
    calls = []
    for _ in range(3):
        remembered(spark.read.parquet(path), "test", lambda: calls.append(1))
    assert len(calls) == 1 and len(_KNOWN) <= MOST_KNOWN


def _store(spark, folder, **changed):
    """The golden tables in ``folder``; some of them written over."""
    t = golden(spark) | changed
    for name, df in (changed or t).items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return read_tables(spark, folder)


def test_a_new_manager_reaches_snapshot_benchmarks_and_history(spark, tmp_path):
    folder = str(tmp_path)
    t = _store(spark, folder)
    before = history.historic_employee_records(t, AS_OF).collect()
    assert {r.manager for r in snapshot.current_snapshot(t, AS_OF).collect()} == {"Bo Kim"}
    new = frames(spark, department_manager=[(10, 5, "2017-01-01", "9999-01-01")])["department_manager"]
    t = _store(spark, folder, department_manager=new)
    assert {r.manager for r in snapshot.current_snapshot(t, AS_OF).collect()} == {"Ann Lee"}
    after = history.historic_employee_records(t, AS_OF).collect()
    assert {r.manager for r in before} == {"Ann Lee", "Bo Kim"} and {r.manager for r in after} == {"Ann Lee"}
    raised = frames(spark, salary=[(1, 90000, "2018-02-28", "9999-01-01")])["salary"]
    t = _store(spark, folder, salary=raised)
    assert {r.gender_benchmark_salary for r in history.historic_employee_records(t, AS_OF).collect()} == {90000.0}


def test_named_queries_follow_their_source(spark, tmp_path):
    folder = f"{tmp_path}/source"
    _store(spark, folder)
    label = f"tables:{folder}"
    assert QUERIES["current_snapshot"](spark, label).head().manager == "Bo Kim"
    same = warehouse(spark, label).root
    assert warehouse(spark, label).root == same
    new = frames(spark, department_manager=[(10, 5, "2017-01-01", "9981-01-01"), (11, 5, "2017-01-01", "9999-01-01")])
    _store(spark, folder, employee=frames(spark, employee=[(1, "1990-05-05", "Cy", "Doe", "F", "2018-02-28"),
                                                           (11, "1975-01-01", "Zoe", "Kim", "M", "2010-01-01")])["employee"],
           department_manager=new["department_manager"])
    assert QUERIES["current_snapshot"](spark, label).head().manager == "Zoe Kim"
    assert QUERIES["company_dashboard"](spark, label).head().employee_count == 1
    assert warehouse(spark, label).root != same
    assert {r.manager for r in catalog.historic_employee_records(spark, label).collect()} == {"Zoe Kim"}
