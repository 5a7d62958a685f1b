"""One run date for all named queries: Spark and SQL agree at other dates than the default."""

import datetime as dt
import os

import pytest

from checks.compare import compare
from paytrail.plans import catalog

SF = "/root/testdata/sf0.001"
DATED = ["current_snapshot", "tenure_years", "employee_age", "title_tenure_months", "company_dashboard", "benchmark_tenure",
         "history_vs_tenure", "employee_deep_dive", "title_history_months", "department_history_months"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
@pytest.mark.parametrize("day", [dt.date(2024, 2, 29), dt.date(2013, 6, 30)])
def test_queries_at_a_date_match_their_statements(spark, day):
    report = compare(spark, SF, keys=DATED, verbose=False, as_of=day)
    assert not {k: r for k, r in report.items() if not (r.get("hash_match") and r.get("columns_match")) or r.get("type_diffs")}


def test_the_date_holds_for_its_own_queries_only(spark, monkeypatch):
    monkeypatch.setitem(catalog.QUERIES, "dated", lambda spark, sf_dir: spark.range(1).selectExpr(f"'{catalog.as_of()}' AS day"))
    at = catalog.queries(dt.date(2013, 6, 30))["dated"](spark, SF).first().day
    assert (at, catalog.queries()["dated"](spark, SF).first().day) == ("2013-06-30", "2020-12-31")
    assert set(catalog.queries(dt.date(2013, 6, 30))) == set(catalog.QUERIES)
