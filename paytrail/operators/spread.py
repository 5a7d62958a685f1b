"""Rows of any key dealt over many tasks in one order, and counts along that order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.joins import materialize

PART, TIE = "__part", "__tie"


def dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df``, stored, with ``__part``: the number of the range of ``order`` that a row
    lies in.  Ranges follow the rows, not the keys, and equal rows are told apart by a
    running number (``__tie``), so neither a key nor a date nor copies of a row can
    fill one range."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.withColumn(TIE, F.monotonically_increasing_id()), "rows")
    return materialize(rows.repartitionByRange(parts, *order, F.col(TIE)).withColumn(PART, F.spark_partition_id()), "dealt")


def running(rows: DataFrame, group: Sequence[str], order: Sequence[Column], amount: Column, out: str) -> DataFrame:
    """Running total of ``amount`` within ``group`` along ``order``, from :func:`dealt`
    rows of (group, order); ``out`` includes the row itself.

    Each (range, group) is totalled by itself; only their totals, at most one for each
    range and group, are carried on from range to range.
    """
    inside = Window.partitionBy(PART, *group).orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(PART, *group).agg(F.sum(amount).alias("__n")).select(
        PART, *group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    same = F.col(f"r.{PART}") == F.col(f"t.{PART}")
    for g in group:
        same = same & F.col(f"r.{g}").eqNullSafe(F.col(f"t.{g}"))
    summed = rows.withColumn(out, F.sum(amount).over(inside))
    return summed.alias("r").join(totals.alias("t"), same).select(
        *[F.col(f"r.{c}") for c in rows.columns], (F.col(f"r.{out}") + F.col("__before")).alias(out))
