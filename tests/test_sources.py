"""Tables that already exist as parquet or in the catalog, staged end to end."""

import datetime as dt

from pyspark.sql import functions as F

from paytrail.plans import pipeline
from paytrail.plans.catalog import QUERIES
from paytrail.sources.staging import read_tables, rejected_rows, warehouse
from tables import frames

RAW = dict(
    employee=[(1, "1970-02-28", "Cy", "Doe", "F", "2000-02-29"), (10, "1960-01-01", "Ann", "Lee", "M", "1990-01-01")],
    title=[(1, "Staff", "2000-02-29", "9999-01-01")],
    salary=[(1, 100, "2000-02-29", "2001-02-28"), (1, 110, "2001-02-28", "9999-01-01")],
    department_employee=[(1, 5, "2000-02-29", "9999-01-01")],
    department_manager=[(10, 5, "1995-01-01", "9999-01-01")],
    department=[(5, "Research")])


def test_own_tables_are_staged_and_queried(spark, tmp_path):
    for name, df in frames(spark, **RAW).items():
        df.selectExpr("*", "'x' AS extra").write.parquet(f"{tmp_path}/{name}")
    label = f"tables:{tmp_path}"
    staged = warehouse(spark, label, tables=read_tables(spark, str(tmp_path))).staged()
    got = {(r.from_date, r.to_date) for r in staged["salary"].collect()}
    assert got == {(dt.date(2018, 2, 28), dt.date(2019, 2, 28)), (dt.date(2019, 2, 28), dt.date(9999, 1, 1))}
    snap = QUERIES["current_snapshot"](spark, label).collect()
    assert [(r.employee_id, r.salary, r.salary_percentage_change, r.manager) for r in snap] == [(1, 110, 10.0, "Ann Lee")]


def _with_character_departments(spark, folder):
    """The tables of RAW with department d005; one salary and one title cannot be read."""
    made = frames(spark, **RAW)
    key = F.format_string("d%03d", "key")
    for name, column in (("department", "id"), ("department_employee", "department_id"), ("department_manager", "department_id")):
        made[name] = made[name].withColumn("key", F.col(column)).withColumn(column, key).drop("key")
    made["salary"] = made["salary"].withColumn("amount", F.col("amount").cast("string")).union(
        spark.sql("SELECT 7L, 'much', DATE '2000-01-01', DATE '9999-01-01'"))
    made["title"] = made["title"].withColumn("from_date", F.col("from_date").cast("string")).union(
        spark.sql("SELECT 7L, 'Staff', 'soon', DATE '9999-01-01'"))
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}")


def test_keys_keep_the_type_of_the_source_through_the_batch(spark, tmp_path):
    _with_character_departments(spark, tmp_path)
    out = f"{tmp_path}/out"
    pipeline.run(spark, f"tables:{tmp_path}", out)
    snap = spark.read.parquet(f"{out}/current_employee_snapshot").collect()
    assert [(r.employee_id, r.salary, r.department, r.manager) for r in snap] == [(1, 110, "Research", "Ann Lee")]
    hist = spark.read.parquet(f"{out}/historic_employee_records")
    assert dict(hist.dtypes)["employee_id"] == "bigint" and hist.count() == 2
    staged = warehouse(spark, f"tables:{tmp_path}").staged()
    assert [r.department_id for r in staged["department_employee"].collect()] == ["d005"]
    bad = {r.table_name: (r["columns"], r.row) for r in spark.read.parquet(f"{out}/rejected_rows").collect()}
    assert {n: columns for n, (columns, _) in bad.items()} == {"salary": ["amount"], "title": ["from_date"]}
    assert '"much"' in bad["salary"][1] and '"soon"' in bad["title"][1]


def test_mixed_key_types_become_character(spark, tmp_path):
    made = frames(spark, **RAW)
    made["department"] = made["department"].withColumn("id", F.col("id").cast("string"))
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}")
    read = read_tables(spark, str(tmp_path))
    assert {dict(read[n].dtypes)[c] for n, c in (("department", "id"), ("department_employee", "department_id"))} == {"string"}
    assert dict(read["salary"].dtypes)["employee_id"] == "bigint"
    assert rejected_rows(spark, str(tmp_path)).count() == 0
