"""The sweep join and the ranges it rests on, against plain Spark and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paytrail.operators.quantiles import exact_quantiles, value_counts
from paytrail.operators.scd import Period, overlap_join
from paytrail.operators.spread import PART, dealt, running

BASE = dt.date(2015, 1, 1)


def _frame(spark, rng, n, p, days):
    rows = []
    for i in range(n):
        a = BASE + dt.timedelta(days=rng.randrange(days))
        b = a + dt.timedelta(days=rng.randrange(-2, 9))
        rows.append((rng.choice([1, 2, None]), i, rng.choice([a, a, a, None]), rng.choice([b, b, b, None, dt.date(9999, 1, 1)])))
    return spark.createDataFrame(rows, f"k int, {p}_id int, {p}_s date, {p}_e date")


@pytest.mark.parametrize("bounds", ["closed", "half_open"])
@pytest.mark.parametrize("days", [1, 40])
def test_sweep_equals_pairwise(spark, bounds, days):
    rng = random.Random(days)
    a, b, c = (_frame(spark, rng, n, p, days) for n, p in ((40, "a"), (30, "b"), (7, "c")))
    inputs = [Period(a, "a_s", "a_e"), Period(b, "b_s", "b_e"), Period(c, "c_s", "c_e")]
    plain = overlap_join(inputs, "k", bounds=bounds)
    swept = overlap_join(inputs, "k", bounds=bounds, sweep=True)
    assert swept.columns == plain.columns
    got, want = (sorted(map(repr, df.collect())) for df in (swept, plain))
    assert got == want and (want or (bounds, days) == ("half_open", 1))


def test_a_key_with_all_rows_on_one_day_is_dealt_to_many_tasks(spark):
    rows = spark.range(40_000).selectExpr("1 AS k", "DATE'2020-01-01' AS s", "DATE'2020-01-01' AS e", "id")
    one = spark.sql("SELECT 1 AS k, DATE'2019-01-01' AS s2, DATE'9999-01-01' AS e2")
    sizes = [r["count"] for r in dealt(rows, [F.col("k"), F.col("s")]).groupBy(PART).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 3 * 40_000 / len(sizes) and sum(sizes) == 40_000
    assert overlap_join([Period(rows, "s", "e"), Period(one, "s2", "e2")], "k", sweep=True).count() == 40_000


def test_cost_follows_the_result(spark):
    """Periods of one key in a row meet their neighbours only; all pairs would be 9 million."""
    a = spark.range(3000).selectExpr("7 AS k", "id", "date_add(DATE'2000-01-01', CAST(id * 2 AS INT)) AS s",
                                     "date_add(DATE'2000-01-01', CAST(id * 2 + 1 AS INT)) AS e")
    b = a.selectExpr("k", "id AS id2", "s AS s2", "date_add(e, 1) AS e2")
    got = overlap_join([Period(a, "s", "e"), Period(b, "s2", "e2")], "k", sweep=True)
    assert got.selectExpr("count(*)", "max(abs(id - id2))").head()[:] == (5999, 1)


def test_running_totals_go_on_over_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", None]), rng.randrange(20), rng.randrange(5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    order = [F.col("g"), F.col("v")]
    got = running(dealt(df, order), ["g"], order, F.col("n"), "upto").groupBy("g", "v").agg(F.max("upto").alias("m")).collect()
    for r in got:
        assert r.m == sum(n for g, v, n in rows if g == r.g and v <= r.v)


@pytest.mark.parametrize("window_bytes", [-1, 1 << 30])
def test_exact_quantiles_equal_percentile(spark, tmp_path, window_bytes):
    rng = random.Random(9)
    rows = [(rng.choice(["F", "M", None]), rng.choice([None, *range(50)])) for _ in range(501)] + [("one", 5), ("none", None), ("two", 1), ("two", 2)]
    spark.createDataFrame(rows, "g string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    at = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    counts = value_counts(df, ["g"], "v", window_bytes=window_bytes)
    got = exact_quantiles(counts, ["g"], "v", at, [F.sum("__n").alias("n")], window_bytes)
    want = df.groupBy("g").agg(*[F.percentile(F.col("v").cast("double"), F.lit(p)).alias(c) for c, p in at.items()],
                               F.count(F.lit(1)).alias("n"))
    key = lambda r: str(r.g)
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert a.g == b.g and a.n == b.n
        assert all(a[c] == b[c] or abs(a[c] - b[c]) < 1e-9 for c in at), (a, b)
