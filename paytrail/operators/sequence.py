"""Ordered per-key sequence features (LAG, LEAD, ROW_NUMBER).

Ordinary keys take one plain window: one shuffle (none if the input is already
partitioned by the key) and one sort.  A key that holds a large share of the table
would fill one task; given its cuts (``heavy``), its rows go another way:

1. they are shuffled on (key, slice) and sorted inside partitions;
2. the window runs per (key, slice): in-slice LAG / LEAD / ROW_NUMBER;
3. the first and last row of every slice go through a window per key that holds at
   most two rows per slice: it gives each slice the last row of the previous
   non-empty slice, the first row of the next one and the row counts before / after;
4. these summaries are joined back on (key, slice) and fix the first / last row.

Results equal the plain window for any order that is total within a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.slices import CUTS, KEY as _KEY, key_struct, slice_of

_SLICE, _RN, _CNT, _LASTROW, _ROW = (
    "__slice", "__rn", "__cnt", "__lastrow", "__row")
_BEFORE, _AFTER, _LAST, _FIRST, _PREV, _NEXT = (
    "__before", "__after", "__last", "__first", "__prev", "__next")
# Slice number of rows whose leading order value is NULL: sorts after all others.
_NULL_SLICE = 2 ** 62


def _order_key(order: Sequence[str]) -> Column:
    """One long comparing like ``ORDER BY d1 ASC NULLS LAST, d2 ASC NULLS LAST`` over
    at most two dates (23 bits hold the days of the years 1 to 9999, and NULL above)."""
    if len(order) > 2:
        raise ValueError("at most two date columns")
    day = [F.coalesce(F.unix_date(c) + (1 << 21), F.lit((1 << 23) - 1)).cast("long") for c in order]
    return day[0] if len(day) == 1 else day[0] * (1 << 23) + day[1]


def _sort(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def ordered_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lags: Mapping[str, str] | None = None,
    leads: Mapping[str, str] | None = None,
    number: str | None = None,
    number_desc: str | None = None,
    number_desc_max: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Add per-key sequence columns ordered by ``order`` (ASC NULLS LAST).

    ``lags`` / ``leads`` map output name -> source column (offset 1);
    ``number`` is ROW_NUMBER in that order, ``number_desc`` ROW_NUMBER in the
    exact reverse order (DESC NULLS FIRST).  ``order[0]`` must be a date
    column; it defines the slices.  ``order`` must be total within a key for a
    deterministic result, exactly as for the plain window.
    ``number_desc_max`` keeps only rows whose ``number_desc`` is at most that
    (the latest rows of each key).  ``heavy`` are the heavy keys of ``df``
    (:func:`~paytrail.operators.slices.heavy_keys`); without them all keys are ordinary.
    """
    keys, order = list(keys), list(order)
    lags, leads = dict(lags or {}), dict(leads or {})
    if heavy is None:
        return _plain(df, keys, order, lags, leads, number, number_desc, number_desc_max)
    keyed = df.withColumn(_KEY, key_struct(keys))
    ordinary = keyed.join(heavy, _KEY, "left_anti").select(df.columns)
    cut = keyed.join(heavy, _KEY)
    return _plain(ordinary, keys, order, lags, leads, number, number_desc, number_desc_max).unionByName(
        _by_slices(cut, df.columns, order, lags, leads, number, number_desc, number_desc_max))


def heavy_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str], heavy: DataFrame, *,
                   lags: Mapping[str, str] | None = None, leads: Mapping[str, str] | None = None,
                   number: str | None = None, number_desc: str | None = None,
                   number_desc_max: int | None = None) -> DataFrame:
    """:func:`ordered_sequence` of rows whose keys are all ``heavy``."""
    cut = df.withColumn(_KEY, key_struct(keys)).join(heavy, _KEY)
    return _by_slices(cut, df.columns, list(order), dict(lags or {}), dict(leads or {}), number, number_desc, number_desc_max)


def _plain(df: DataFrame, keys: list[str], order: list[str], lags: dict[str, str], leads: dict[str, str],
           number: str | None, number_desc: str | None, number_desc_max: int | None) -> DataFrame:
    up = Window.partitionBy(*keys).orderBy(*_sort(order))
    down = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    # Where only the reverse number is asked for, one sort serves all columns.
    w, lag, lead = (down, F.lead, F.lag) if number_desc and not number else (up, F.lag, F.lead)
    res = df.select("*", *[lag(src).over(w).alias(out) for out, src in lags.items()],
                    *[lead(src).over(w).alias(out) for out, src in leads.items()],
                    *([F.row_number().over(up).cast("long").alias(number)] if number else []),
                    *([F.row_number().over(down).cast("long").alias(number_desc)] if number_desc else []))
    if number_desc and number_desc_max is not None:
        res = res.filter(F.col(number_desc) <= number_desc_max)
    return res


def _by_slices(df: DataFrame, out_cols: list[str], order: list[str], lags: dict[str, str],
               leads: dict[str, str], number: str | None, number_desc: str | None,
               number_desc_max: int | None) -> DataFrame:
    date = F.col(order[0])
    shuffled = (df.withColumn(_SLICE, F.when(date.isNull(), F.lit(_NULL_SLICE)).otherwise(slice_of(date)))
                .drop(CUTS).repartition(_KEY, _SLICE))

    w = Window.partitionBy(_KEY, _SLICE).orderBy(*_sort(order))
    win = shuffled.sortWithinPartitions(_KEY, _SLICE, *_sort(order)).select(
        "*",
        F.row_number().over(w).cast("long").alias(_RN),
        F.lead(F.lit(1)).over(w).isNull().alias(_LASTROW),
        *[F.lag(src).over(w).alias(f"__lag_{out}") for out, src in lags.items()],
        *[F.lead(src).over(w).alias(f"__lead_{out}") for out, src in leads.items()])
    rows = win

    # Boundary rows (first and last of each slice).  They keep every input
    # column, so this branch reads the very same shuffle as ``rows`` (a reused
    # exchange) instead of a column-pruned second one.
    bnd = win.filter((F.col(_RN) == 1) | F.col(_LASTROW)).select(
        _KEY, _SLICE, _RN, _LASTROW, F.struct(*out_cols).alias(_ROW))
    wb = Window.partitionBy(_KEY).orderBy(_SLICE, _RN)
    size_if_last = F.when(F.col(_LASTROW), F.col(_RN))
    bnd = bnd.select(
        _KEY, _SLICE, _RN, _LASTROW,
        F.lag(_ROW).over(wb).alias(_PREV),
        F.lead(_ROW).over(wb).alias(_NEXT),
        F.coalesce(F.sum(size_if_last).over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_BEFORE),
        (F.sum(size_if_last).over(Window.partitionBy(_KEY))
         - F.coalesce(F.sum(size_if_last).over(wb.rowsBetween(Window.unboundedPreceding, 0)),
                      F.lit(0))).alias(_AFTER))
    # A slice's first boundary row is followed by its last one (unless it is
    # both): move the last row's facts onto the first and keep one row per slice.
    own_or_next = lambda c: F.when(F.col(_LASTROW), F.col(c)).otherwise(F.lead(c).over(wb))
    summary = bnd.select(
        _KEY, _SLICE, _RN, _PREV, _BEFORE,
        own_or_next(_RN).alias(_CNT), own_or_next(_NEXT).alias(_NEXT),
        own_or_next(_AFTER).alias(_AFTER),
    ).filter(F.col(_RN) == 1)
    # Only the carried fields travel on to the join.
    lag_src, lead_src = sorted(set(lags.values())), sorted(set(leads.values()))
    carried = [_KEY, _SLICE, _BEFORE, _CNT, _AFTER]
    if lag_src:
        carried.append(F.struct(*[F.col(_PREV).getField(c).alias(c) for c in lag_src]).alias(_PREV))
    if lead_src:
        carried.append(F.struct(*[F.col(_NEXT).getField(c).alias(c) for c in lead_src]).alias(_NEXT))
    summary = summary.select(*carried)
    if number_desc and number_desc_max is not None:
        # Slices followed by at least number_desc_max rows hold no wanted row.
        summary = summary.filter(F.col(_AFTER) < number_desc_max)

    j = rows.join(summary, [_KEY, _SLICE])
    first, last = F.col(_RN) == 1, F.col(_LASTROW)
    res = []
    for out, src in lags.items():
        res.append(F.when(first, F.col(_PREV).getField(src))
                   .otherwise(F.col(f"__lag_{out}")).alias(out))
    for out, src in leads.items():
        res.append(F.when(last, F.col(_NEXT).getField(src))
                   .otherwise(F.col(f"__lead_{out}")).alias(out))
    if number:
        res.append((F.col(_BEFORE) + F.col(_RN)).cast("long").alias(number))
    if number_desc:
        res.append((F.col(_AFTER) + F.col(_CNT) - F.col(_RN) + 1).cast("long").alias(number_desc))
    out = j.select(*out_cols, *res)
    if number_desc and number_desc_max is not None:
        out = out.filter(F.col(number_desc) <= number_desc_max)
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   values: Sequence[str]) -> DataFrame:
    """``values`` of the row ranked first by ``order`` (one or two dates) DESC NULLS
    FIRST within each key, as a partial hash aggregation instead of a window."""
    rank = _order_key(order)
    return df.groupBy(*keys).agg(*[F.max_by(v, rank).alias(v) for v in values])
