"""Every registered query against its DuckDB statement at sf0.001, and the
driver's smoke entry."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from paytrail.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


def test_entry_smoke(spark):
    rows = entry.entry(spark).collect()
    assert {r.gender for r in rows} == {"F", "M"}
    f = [r for r in rows if r.gender == "F"][0]
    assert (f.employee_count, f.employee_percentage, f.avg_salary, f.median_salary) == \
        (50, 42.0, 293644.0, 317786.0)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


def test_all_queries_match_oracle(spark):
    report = compare(spark, SF, keys=sorted(QUERIES), verbose=False)
    bad = {k: r for k, r in report.items()
           if not (r.get("hash_match") and r.get("columns_match")) or r.get("type_diffs")}
    assert not bad, bad
