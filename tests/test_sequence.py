"""Heavy keys cut into slices give what the plain window gives, NULLs included."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.operators.sequence import latest_per_key, ordered_sequence
from paytrail.operators.slices import heavy_keys, slice_of

BASE = dt.date(2010, 1, 1)


def _frame(spark, seed, n, null_share):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 6)  # key 0 is hot
        if rnd.random() < 0.05:
            key = None
        d = None if rnd.random() < null_share else BASE + dt.timedelta(days=rnd.randint(0, 3000))
        rows.append((key, d, i, rnd.choice(["a", "b", None]), rnd.randint(0, 100)))
    return spark.createDataFrame(rows, "k long, d date, uid long, s string, v int")


def _run(df, rows):
    out = ordered_sequence(df, ["k"], ["d", "uid"], lags={"prev_v": "v", "prev_s": "s"},
                           leads={"next_d": "d"}, number="n_asc", number_desc="n_desc",
                           heavy=heavy_keys([(df, ["k"], "d")], rows))
    return sorted((tuple(r) for r in out.collect()), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n=st.integers(1, 120),
       null_share=st.sampled_from([0.0, 0.1, 0.5]), rows=st.sampled_from([1, 5, 40]))
def test_sliced_equals_plain(spark, seed, n, null_share, rows):
    df = _frame(spark, seed, n, null_share)
    assert _run(df, rows) == _run(df, None)


def test_input_partitioning_does_not_matter(spark):
    df = _frame(spark, 7, 200, 0.1)
    assert _run(df.repartition(7), 10) == _run(df.coalesce(1), 10)


def test_latest_per_key_prefers_null_then_latest(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), 10), (1, dt.date(2021, 1, 1), 20), (2, None, 5),
         (2, dt.date(2030, 1, 1), 6)], "k long, t date, v int")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"], ["v"]).collect()}
    assert got == {1: 20, 2: 5}


def test_latest_rows_only_equals_filtered_plain(spark):
    df = _frame(spark, 11, 300, 0.1)
    def top(rows):
        out = ordered_sequence(df, ["k"], ["d", "uid"], lags={"prev_v": "v"},
                               number_desc="n_desc", number_desc_max=3,
                               heavy=heavy_keys([(df, ["k"], "d")], rows))
        return sorted((tuple(r) for r in out.collect()), key=repr)
    full = ordered_sequence(df, ["k"], ["d", "uid"], lags={"prev_v": "v"},
                            number="n_asc", number_desc="n_desc").drop("n_asc").filter("n_desc <= 3")
    want = sorted((tuple(r) for r in full.collect()), key=repr)
    assert top(10) == want and top(None) == want


def test_a_key_with_all_rows_in_one_year_is_cut_evenly(spark):
    days = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k",
                                        "date_add(DATE'2015-01-01', CAST(id % 365 AS INT)) AS d")
    stray = spark.createDataFrame([(0, dt.date(9990, 1, 1))], "k long, d date")
    df = days.unionByName(stray)
    heavy = heavy_keys([(df, ["k"], "d")], 100)
    cut = df.selectExpr("struct(k AS k0) AS __key", "d").join(heavy, "__key")
    sizes = [r["count"] for r in cut.groupBy(slice_of(F.col("d"))).count().collect()]
    assert len(sizes) >= 9 and max(sizes) <= 150 and sum(sizes) == 1001
    assert heavy_keys([(df, ["k"], "d")], 2000) is None


def test_ordinary_keys_take_one_shuffle(spark):
    df = _frame(spark, 3, 50, 0.1)
    plan = ordered_sequence(df, ["k"], ["d", "uid"], lags={"prev_v": "v"}, number_desc="n")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1
