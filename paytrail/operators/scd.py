"""Slowly-changing-dimension operators: current rows, previous values and the
K-way validity-period overlap join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.config import OPEN_END
from paytrail.operators.slices import KEY, key_struct
from paytrail.operators.sweep import sweep_join

_EFF, _EXP = "__eff", "__exp"


def _low() -> Column:
    return F.lit("0001-01-01").cast("date")


def _high() -> Column:
    return F.lit("9999-12-31").cast("date")


def current(df: DataFrame, to_col: str = "to_date", open_end: dt.date = OPEN_END) -> DataFrame:
    """Rows still valid: ``to_date = open end`` (pushed to the parquet scan)."""
    return df.filter(F.col(to_col) == F.lit(open_end))


@dataclass(frozen=True)
class Period:
    """One input of :func:`overlap_join`: a frame and its validity bounds.

    ``on`` = (column of the accumulated result, column of this frame) when this
    input joins on something other than the common key (e.g. department
    managers join on the department of the employee's period); ``heavy`` are then
    the heavy keys of this frame.
    """
    df: DataFrame
    start: str
    end: str
    on: tuple[str, str] | None = None
    heavy: DataFrame | None = None


def overlap_join(inputs: Sequence[Period], key: str, *, bounds: str = "closed",
                 heavy: DataFrame | None = None, sweep: bool = False, effective: str = "effective_date",
                 expiry: str = "expiry_date") -> DataFrame:
    """All combinations (one row of every input, equal keys) whose validity
    periods intersect: ``GREATEST(starts) <= LEAST(ends)`` (``bounds="closed"``)
    or ``<`` (``"half_open"``).  NULL bounds are skipped like GREATEST/LEAST do.

    Inputs are joined on the key with pairwise overlap tests: each is shuffled once
    at most, and what follows on the key reuses that partitioning.  The pairs of a key
    are then tested one by one, which suits keys with some dozens of rows.  Rows of the
    ``heavy`` keys (:func:`~paytrail.operators.slices.heavy_keys`) are joined by
    :func:`~paytrail.operators.sweep.sweep_join` instead, at a cost that follows the
    result; with ``sweep`` all rows are.  The pairwise tests are implied by the final
    one, so the result equals the plain join followed by the final filter.
    Column names must be unique across inputs except the shared ``key``.
    """
    if bounds not in ("closed", "half_open"):
        raise ValueError("bounds must be 'closed' or 'half_open'")
    strict = bounds == "half_open"
    acc = inputs[0].df.withColumn(_EFF, F.col(inputs[0].start)).withColumn(_EXP, F.col(inputs[0].end))
    for p in inputs[1:]:
        on = p.on or (key, key)
        keys = p.heavy if p.on is not None else heavy
        if sweep and p.on is None:
            acc = _joined(acc, p, on, strict, True)
        elif keys is None:
            acc = _joined(acc, p, on, strict, False)
        else:
            few, many = _apart(acc, on[0], keys), _apart(p.df, on[1], keys)
            acc = _joined(few[0], Period(many[0], p.start, p.end), on, strict, False).unionByName(
                _joined(few[1], Period(many[1], p.start, p.end), on, strict, True))
    out = acc.filter(F.col(_EFF) < F.col(_EXP) if strict else F.col(_EFF) <= F.col(_EXP))
    return out.withColumnRenamed(_EFF, effective).withColumnRenamed(_EXP, expiry)


def _apart(df: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    keyed, keys = df.withColumn(KEY, key_struct([key])), heavy.select(KEY)
    return keyed.join(keys, KEY, "left_anti").select(df.columns), keyed.join(keys, KEY, "left_semi").select(df.columns)


def _joined(acc: DataFrame, p: Period, on: tuple[str, str], strict: bool, sweep: bool) -> DataFrame:
    """One more input: pairs whose periods intersect, with the intersection so far."""
    lk, rk = on
    a_from, a_to = F.coalesce(F.col(f"a.{_EFF}"), _low()), F.coalesce(F.col(f"a.{_EXP}"), _high())
    b_from, b_to = F.coalesce(F.col(f"b.{p.start}"), _low()), F.coalesce(F.col(f"b.{p.end}"), _high())
    if sweep:
        both = sweep_join(acc, p.df, on, (F.coalesce(_EFF, _low()), F.coalesce(_EXP, _high())),
                          (F.coalesce(p.start, _low()), F.coalesce(p.end, _high())), strict)
    else:
        meet = (a_from < b_to) & (b_from < a_to) if strict else (a_from <= b_to) & (b_from <= a_to)
        both = acc.alias("a").join(p.df.alias("b"), (F.col(f"a.{lk}") == F.col(f"b.{rk}")) & meet, "inner")
    keep_a = [F.col(f"a.{c}") for c in acc.columns if c not in (_EFF, _EXP)]
    keep_b = [F.col(f"b.{c}") for c in p.df.columns if not (c == rk and rk == lk)]
    return both.select(*keep_a, *keep_b,
                       F.greatest(F.col(f"a.{_EFF}"), F.col(f"b.{p.start}")).alias(_EFF),
                       F.least(F.col(f"a.{_EXP}"), F.col(f"b.{p.end}")).alias(_EXP))
