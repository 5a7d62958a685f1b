import datetime as dt

from pyspark.sql import functions as F

from paytrail.functions.dates import age_months_field, completed_months, shift_date, year_diff
from paytrail.functions.numeric import full_name, pct_change, round_half_even, round_half_up

D = dt.date.fromisoformat


def one(spark, expr, schema="x date, y date", row=(None, None)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_shift_clamps_29_february(spark):
    assert one(spark, shift_date("x", 18), row=(D("2000-02-29"), None)) == D("2018-02-28")
    assert one(spark, shift_date("x", 18), row=(D("1999-02-28"), None)) == D("2017-02-28")


def test_shift_keeps_open_end_and_null(spark):
    assert one(spark, shift_date("x", 18), row=(D("9999-01-01"), None)) == D("9999-01-01")
    assert one(spark, shift_date("x", 18), row=(None, None)) is None


def test_months_field_of_age(spark):
    assert one(spark, age_months_field("y", "x"), row=(D("2021-01-31"), D("2021-02-28"))) == 0
    assert one(spark, age_months_field("y", "x"), row=(D("2017-12-16"), D("2020-03-15"))) == 2
    assert one(spark, age_months_field("y", "x"), row=(D("2019-02-28"), D("2020-12-31"))) == 10
    # negative ages: the months field of the reversed age, negated
    assert one(spark, age_months_field("y", "x"), row=(D("2021-02-15"), D("2020-12-31"))) == -1


def test_completed_months(spark):
    assert one(spark, completed_months("x", "y"), row=(D("2019-02-28"), D("2020-12-31"))) == 22
    assert one(spark, completed_months("x", "y"), row=(D("2021-01-31"), D("2021-02-28"))) == 0


def test_year_difference_is_calendar_years(spark):
    assert one(spark, year_diff("y", "x"), row=(D("2019-12-31"), D("2020-01-01"))) == 1


def test_concat_ws_skips_null(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(F.concat_ws(" ", F.col("a"), F.col("b"), F.lit("b"))).first()[0] == "a b"
    assert df.select(full_name("a", "b")).first()[0] == "a"


def test_least_skips_null(spark):
    df = spark.createDataFrame([(1, None, 3)], "a int, b int, c int")
    assert df.select(F.least("a", "b", "c")).first()[0] == 1


def test_rounding_modes(spark):
    df = spark.createDataFrame([(2.5,)], "x double")
    assert df.select(round_half_up("x")).first()[0] == 3.0
    assert df.select(round_half_even("x")).first()[0] == 2.0


def test_pct_change_and_zero_divisor(spark):
    df = spark.createDataFrame([(43000, 44000), (5, 0), (5, None)], "a int, b int")
    got = [r[0] for r in df.select(pct_change("a", "b")).collect()]
    assert got == [-2.27, None, None]


def test_exact_mean_ignores_partitions(spark):
    from pyspark.sql import functions as F

    from paytrail.functions.numeric import exact_mean
    df = spark.createDataFrame([(0.1,), (0.2,), (0.7,), (1.0,), (None,)] * 25, "p double")
    got = {df.repartition(n).agg(exact_mean("p").alias("m")).head().m for n in (1, 7, 50)}
    assert got == {0.5}
    assert df.limit(0).agg(exact_mean("p").alias("m")).head().m is None
    assert df.agg(F.round(exact_mean("p"), 0).alias("m")).head().m == 1.0
