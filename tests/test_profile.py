"""Profiling and quality operators on hand-made rows."""

import datetime as dt

from paytrail.operators import profile

D = dt.date.fromisoformat
OPEN = dt.date(9999, 1, 1)


def _salary(spark, rows):
    return spark.createDataFrame(
        [(e, a, D(f) if f else None, (D(t) if isinstance(t, str) else t)) for e, a, f, t in rows],
        "employee_id long, amount int, from_date date, to_date date")


def test_histogram_counts_rows_values_and_distinct(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (1, None), (2, 20)], "k long, v long")
    rows = lambda h: sorted(tuple(r) for r in h.collect())
    assert rows(profile.records_per_key(df, "k")) == [(1, 1), (3, 1)]
    assert rows(profile.records_per_key(df, "k", "v")) == [(1, 1), (2, 1)]
    assert rows(profile.records_per_key(df, "k", "v", distinct=True)) == [(1, 2)]


def test_key_violations_counts_groups_and_rows_and_skips_null_keys(spark):
    sal = _salary(spark, [(1, 5, "2020-01-01", OPEN), (1, 6, "2020-01-01", OPEN),
                          (1, 7, "2020-01-01", OPEN), (2, 1, None, OPEN), (2, 1, None, OPEN)])
    out = profile.key_violations({"salary": sal}, [("salary", ("employee_id", "from_date"))])
    r = out.first()
    assert (r.table_name, r.key_columns, r.duplicate_keys, r.duplicate_rows) == \
        ("salary", "employee_id,from_date", 1, 3)


def test_latest_dates_put_null_first(spark):
    sal = _salary(spark, [(1, 5, "2020-01-01", None), (2, 5, "2020-01-01", OPEN),
                          (3, 5, "2020-01-01", "2020-06-01"), (3, 5, "2019-01-01", "2020-01-01")])
    got = [(r.to_date, r.record_count, r.employee_count)
           for r in profile.latest_dates(sal, n=2).collect()]
    assert got == [(None, 1, 1), (OPEN, 1, 1)]


def test_former_records_counts_rows_of_people_without_open_record(spark):
    sal = _salary(spark, [(1, 5, "2019-01-01", "2020-01-01"), (1, 6, "2020-01-01", OPEN),
                          (2, 5, "2019-01-01", "2020-01-01"), (2, 6, "2020-01-01", "2020-05-01")])
    assert profile.former_records(sal).first().record_count == 2


def test_relationship_types(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "k long, v long")
    assert profile.relationship(df, "t", "k").first().relationship == "1:many"
    assert profile.relationship(df, "t", "v").first().relationship == "1:1"
