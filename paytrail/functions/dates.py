"""Date expressions: sentinel-safe shifts, calendar-year and month differences.

All of them are plain Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from paytrail.config import OPEN_END


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(d) -> Column:
    return F.lit(d) if isinstance(d, dt.date) else _c(d)


def add_years(c, years: int) -> Column:
    """``c + interval 'N years'`` cast to date; 29 Feb falls back to 28 Feb."""
    return F.add_months(_c(c), 12 * years)


def shift_date(c, years: int, open_end: dt.date = OPEN_END) -> Column:
    """Shift an end date but keep the open-end sentinel (NULL stays NULL)."""
    c = _c(c)
    return F.when(c != F.lit(open_end), add_years(c, years)).otherwise(c)


def year_diff(end, start) -> Column:
    """``DATE_PART('year', end) - DATE_PART('year', start)``: calendar years,
    so 2019-12-31 -> 2020-01-01 counts 1."""
    return (F.year(_d(end)) - F.year(_d(start))).cast("long")


def completed_months(start, end) -> Column:
    """Whole months from ``start`` to ``end`` (negative when end < start),
    counted like the year/month fields of an interval age."""
    s, e = _d(start), _d(end)
    forward = (12 * (F.year(e) - F.year(s)) + F.month(e) - F.month(s)
               - F.when(F.dayofmonth(e) < F.dayofmonth(s), 1).otherwise(0))
    backward = (12 * (F.year(s) - F.year(e)) + F.month(s) - F.month(e)
                - F.when(F.dayofmonth(s) < F.dayofmonth(e), 1).otherwise(0))
    return F.when(e >= s, forward).otherwise(-backward).cast("long")


def age_months_field(end, start) -> Column:
    """``DATE_PART('months', AGE(end, start))``: only the months field (0-11,
    negated when start lies after end)."""
    m = completed_months(start, end)
    return F.when(m >= 0, m % 12).otherwise(-((-m) % 12)).cast("long")
