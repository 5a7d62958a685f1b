"""Numeric expressions with the rounding behaviour of the original views.

Integer inputs are widened to double before arithmetic (no 32-bit overflow in
ANSI mode) and divisors equal to zero give NULL instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_diff(new, old) -> Column:
    """``100 * (new - old) / old`` in double precision; NULL when old is 0."""
    n, o = _c(new).cast("double"), _c(old).cast("double")
    return F.lit(100.0) * (n - o) / F.nullif(o, F.lit(0.0))


def pct_change(new, old, scale: int = 2) -> Column:
    """``ROUND(100 * (new - old) / old, scale)``, half away from zero."""
    return F.round(pct_diff(new, old), scale)


def share_pct(part, whole) -> Column:
    """``ROUND(100 * part / whole)`` for counts, half away from zero."""
    return F.round(F.lit(100.0) * _c(part).cast("double")
                   / F.nullif(_c(whole).cast("double"), F.lit(0.0)), 0)


def exact_mean(c, scale: int = 2) -> Column:
    """Mean of values rounded to ``scale`` digits: summed as decimals, so that the
    result depends neither on the order of rows nor on their partitions."""
    total = F.sum(_c(c).cast(f"decimal(18,{scale})"))
    return total.cast("double") / F.nullif(F.count(_c(c)), F.lit(0))


def round_half_even(c, scale: int = 0) -> Column:
    """Rounding of a double precision value (banker's rounding)."""
    return F.bround(_c(c).cast("double"), scale)


def round_half_up(c, scale: int = 0) -> Column:
    """Rounding of an exact numeric value (half away from zero)."""
    return F.round(_c(c).cast("double"), scale)


def full_name(first, last) -> Column:
    """``CONCAT_WS(' ', first, last)``; NULL parts are skipped."""
    return F.concat_ws(" ", _c(first), _c(last))
