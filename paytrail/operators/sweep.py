"""Interval join by a sweep over start and end points.

Two periods intersect exactly if the later start lies within the other period.  All
points of both sides are put into one order (key, day), dealt over many tasks however
many rows a key or a day has, and the starts are numbered along it.  A period then
contains a run of consecutive numbers, which the counts at its two ends tell, and is
joined with the starts of these numbers.  No pair is made that is not a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.operators.slices import key_struct
from paytrail.operators.spread import PART, TIE, dealt, running

Bounds = tuple[Column, Column]
_FIRST, _POINT, _LAST = 0, 1, 2  # order of the events of one day


def _starts_within(points: DataFrame, periods: DataFrame, from_kind: int, to_kind: int) -> DataFrame:
    """(``point``, ``period``) rows: starts that lie in a period of their key.
    ``points`` has (k, day, row), ``periods`` (k, s, e, row); the kinds tell whether
    starts of the first and last day count."""
    none = F.lit(None)
    p_type, i_type = points.schema["row"].dataType, periods.schema["row"].dataType
    numbered = periods.withColumn("id", F.monotonically_increasing_id())
    ends = F.explode(F.array(F.struct(F.col("s").alias("day"), F.lit(from_kind).alias("kind"), F.lit(True).alias("opens")),
                             F.struct(F.col("e").alias("day"), F.lit(to_kind).alias("kind"), F.lit(False).alias("opens"))))
    marks = numbered.select("k", "id", "row", ends.alias("x")).select(
        "k", "x.day", "x.kind", none.cast(p_type).alias("point"), "id", "x.opens",
        F.when(F.col("x.opens"), F.col("row")).otherwise(none.cast(i_type)).alias("period"))
    events = points.select("k", "day", F.lit(_POINT).alias("kind"), F.col("row").alias("point"), none.cast("long").alias("id"),
                           none.cast("boolean").alias("opens"), none.cast(i_type).alias("period")).unionByName(marks)
    order = [F.col("k"), F.col("day"), F.col("kind")]
    counted = running(dealt(events, order), [], order, F.when(F.col("kind") == _POINT, 1).otherwise(0), "number").drop(PART, TIE)
    opened = counted.where("opens").select("id", "period", F.col("number").alias("before"))
    closed = counted.where("not opens").select("id", F.col("number").alias("upto"))
    runs = opened.join(closed, "id").where(F.col("upto") > F.col("before")).select(
        "period", F.explode(F.sequence(F.col("before") + 1, F.col("upto"))).alias("number"))
    return runs.join(counted.where(F.col("kind") == _POINT).select("number", "point"), "number").select("point", "period")


def sweep_join(a: DataFrame, b: DataFrame, on: tuple[str, str], a_bounds: Bounds, b_bounds: Bounds, strict: bool) -> DataFrame:
    """Rows of ``a`` and ``b`` (columns under the aliases ``a`` and ``b``) with equal keys
    whose periods intersect; bounds are never NULL.  NULL keys meet nothing; a period
    that ends before it starts (``strict``: or on that day) meets nothing."""
    def rows(df: DataFrame, key: str, bounds: Bounds) -> DataFrame:
        s, e = bounds
        return df.where(F.col(key).isNotNull() & (s < e if strict else s <= e)).select(
            key_struct([key]).alias("k"), s.alias("s"), e.alias("e"), F.struct(*[F.col(c) for c in df.columns]).alias("row"))

    left, right = rows(a, on[0], a_bounds), rows(b, on[1], b_bounds)
    to_kind = _FIRST if strict else _LAST
    starts = lambda side: side.select("k", F.col("s").alias("day"), "row")
    later_a = _starts_within(starts(left), right, _FIRST, to_kind).select(F.col("point").alias("a"), F.col("period").alias("b"))
    later_b = _starts_within(starts(right), left, _LAST, to_kind).select(F.col("period").alias("a"), F.col("point").alias("b"))
    return later_a.unionByName(later_b).select(F.col("a"), F.col("b"))
