"""The overlap join, keys cut into slices or whole, equals the plain join followed by the
GREATEST <= LEAST filter (NULL bounds, inverted and zero-length periods)."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.operators.scd import Period, overlap_join
from paytrail.operators.slices import heavy_keys

BASE = dt.date(2015, 1, 1)


def _periods(rnd, n, prefix, nkeys, key="k"):
    rows = []
    for i in range(n):
        a = BASE + dt.timedelta(days=rnd.randint(0, 2000))
        b = a + dt.timedelta(days=rnd.randint(-20, 700))
        if rnd.random() < 0.1:
            a = None
        if rnd.random() < 0.1:
            b = None
        if rnd.random() < 0.1:
            b = dt.date(9999, 1, 1)
        rows.append((rnd.randint(0, nkeys), i, a, b))
    return rows


def _frames(spark, seed):
    rnd = random.Random(seed)
    t = spark.createDataFrame(_periods(rnd, 40, "t", 3), "k long, t_id long, t_from date, t_to date")
    s = spark.createDataFrame(_periods(rnd, 60, "s", 3), "k long, s_id long, s_from date, s_to date")
    m = spark.createDataFrame(_periods(rnd, 15, "m", 2),
                              "g long, m_id long, m_from date, m_to date")
    t = t.withColumn("g", F.col("t_id") % 3)
    return t, s, m


def _plain(t, s, m, strict):
    j = t.join(s, "k").join(m, "g")
    eff = F.greatest("t_from", "s_from", "m_from")
    exp = F.least("t_to", "s_to", "m_to")
    j = j.withColumn("effective_date", eff).withColumn("expiry_date", exp)
    return j.filter(eff < exp if strict else eff <= exp)


def _cols(df):
    return sorted((tuple(r) for r in df.select("k", "t_id", "s_id", "m_id", "effective_date",
                                                "expiry_date").collect()), key=repr)


def _heavy(t, s, rows):
    return heavy_keys([(t, ["k"], "t_from"), (s, ["k"], "s_from")], rows)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), rows=st.sampled_from([1, 8, 25, None]),
       bounds=st.sampled_from(["closed", "half_open"]))
def test_sliced_equals_plain(spark, seed, rows, bounds):
    t, s, m = _frames(spark, seed)
    got = overlap_join([Period(t, "t_from", "t_to"), Period(s, "s_from", "s_to"),
                        Period(m, "m_from", "m_to", on=("g", "g"),
                               heavy=heavy_keys([(m, ["g"], "m_from")], rows))],
                       key="k", bounds=bounds, heavy=_heavy(t, s, rows))
    assert _cols(got) == _cols(_plain(t, s, m, bounds == "half_open"))


def test_every_row_is_valid(spark):
    t, s, m = _frames(spark, 3)
    got = overlap_join([Period(t, "t_from", "t_to"), Period(s, "s_from", "s_to")], key="k")
    assert got.filter(~(F.col("effective_date") <= F.col("expiry_date"))).count() == 0


def test_one_stray_start_date_copies_no_rows(spark):
    def day(y, m=1):
        return dt.date(y, m, 1)

    rows = [(k % 50, day(2000 + k % 5), day(9999)) for k in range(500)] + [(7, day(9990), day(9999))]
    a = spark.createDataFrame(rows, "k int, s date, e date")
    b = a.selectExpr("k", "s as s2", "e as e2")
    want = a.join(b, "k").where("greatest(s, s2) <= least(e, e2)").count()
    for limit in (None, 1):
        heavy = heavy_keys([(a, ["k"], "s"), (b, ["k"], "s2")], limit)
        assert overlap_join([Period(a, "s", "e"), Period(b, "s2", "e2")], "k", heavy=heavy).count() == want
    slices = heavy.selectExpr("max(size(__cuts))").first()[0]
    assert slices <= 6  # at most one for each date of the key
