"""The batch pipeline writes every table and agrees with the named queries."""

import os

import pytest

from paytrail.plans import pipeline
from paytrail.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


def test_pipeline_matches_queries(spark, tmp_path):
    out = str(tmp_path / "out")
    times = pipeline.run(spark, SF, out)
    assert "employee_deep_dive" in times and "stage" in times

    def same(table, key):
        a = sorted(map(repr, map(tuple, spark.read.parquet(f"{out}/{table}").collect())))
        b = sorted(map(repr, map(tuple, QUERIES[key](spark, SF).collect())))
        assert a == b, table

    same("company_level_dashboard", "company_dashboard")
    same("title_benchmark", "benchmark_title")
    same("historic_employee_records", "historic_employee_records")
    same("employee_deep_dive", "employee_deep_dive")
