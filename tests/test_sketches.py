"""Sketches against exact values: error bounds, levels united from one pass, empty and null groups."""

from pyspark.sql import functions as F

from paytrail.operators import sketches
from paytrail.plans import sketched

N = 60_000


def test_distinct_sketches_unite_within_their_error(spark):
    rows = spark.range(3 * N).select((F.col("id") % N).alias("v"), F.when(F.col("id") < N, "a").otherwise("b").alias("k"),
                                     (F.col("id") % 7).alias("d"))
    made = sketches.distinct_sketches(rows, ["k", "d"], "v")
    for keys in (["k"], []):
        for r in sketches.united_distinct(made, keys).select(sketches.distinct_estimate().alias("n")).collect():
            assert abs(r.n - N) <= 4 * sketches.distinct_error() * N


def test_distinct_of_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1)], "k string, v bigint")
    made = sketches.distinct_sketches(rows, ["k"], "v")
    assert {(r.k, r.n) for r in made.select("k", sketches.distinct_estimate().alias("n")).collect()} == {("a", 0), ("b", 1)}
    empty = sketches.distinct_sketches(rows.limit(0), [], "v").select(sketches.distinct_estimate().alias("n"))
    assert empty.first().n == 0


def test_quantile_sketches_unite_within_their_error(spark):
    # A third of the rows are one value; the others are spread over two groups in order.
    rows = spark.range(N).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"),
                                 F.when(F.col("id") < 50_000, "a").otherwise("b").alias("k"))
    made = sketches.united_quantiles(sketches.quantile_sketches(rows, ["k"], "v"), [])
    wanted = {"low": 0.1, "q1": 0.25, "mid": 0.5, "q3": 0.75}
    got = made.select(*sketches.quantile_columns(wanted)).first()
    for name, p in wanted.items():
        below, upto = rows.where(F.col("v") < got[name]).count(), rows.where(F.col("v") <= got[name]).count()
        assert below / N <= p + 2 * sketches.rank_error() and upto / N >= p - 2 * sketches.rank_error(), name


def test_quantiles_of_nulls_and_small_groups(spark):
    rows = spark.createDataFrame([("a", None), ("b", 3), ("b", 1), ("b", 2), (None, 9)], "k string, v int")
    made = sketches.quantile_sketches(rows, ["k"], "v").select("k", *sketches.quantile_columns({"mid": 0.5}))
    assert {r.k: r.mid for r in made.collect()} == {"a": None, "b": 2, None: 9}


def test_audits_see_wrong_estimates(spark, monkeypatch):
    snap = spark.range(4000).selectExpr("if(id % 2 = 0, 'M', 'F') AS gender", "if(id % 5 = 0, NULL, 'd') AS department",
                                        "'t' AS title", "CAST(id AS INT) AS salary")
    for level in ("company", "department", "title"):
        assert {tuple(r)[-3:] for r in sketched.quartile_audit(snap, level).collect()} == {(True, True, True)}
    monkeypatch.setattr(sketches, "quantile_columns", lambda p: [F.lit(0).cast("long").alias(n) for n in p])
    assert {tuple(r)[-3:] for r in sketched.quartile_audit(snap, "company").collect()} == {(False, False, False)}
    one = spark.range(100).selectExpr("id AS employee_id", "DATE '2020-01-01' AS to_date")
    tables = {n: one for n in sketched.RELATIONS}
    assert {(r.distinct_employees, r.within_error) for r in sketched.distinct_audit(tables).collect()} == {(100, True)}
    by_date = sketched.distinct_employees(sketched.employee_sketches(tables), "to_date").collect()
    assert [r.employee_estimate for r in by_date] == [100]
