"""Heavy keys: keys with more than ``HEAVY_ROWS`` rows, cut into time slices at
quantiles of their own dates.  All other keys are left whole (slice 0)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.config import HEAVY_ROWS
from paytrail.operators.joins import materialize, remembered

KEY, CUTS = "__key", "__cuts"
_FINEST = 1024  # most slices of one key


def key_struct(keys: Sequence[str], frame: str = "") -> Column:
    """The key columns as one value that is never NULL; NULL fields are equal."""
    return F.struct(*[F.col(f"{frame}{k}").alias(f"k{i}") for i, k in enumerate(keys)])


def heavy_keys(inputs: Sequence[tuple[DataFrame, Sequence[str], str]],
               rows: int | None = HEAVY_ROWS) -> DataFrame | None:
    """Keys with more than ``rows`` rows over all ``inputs`` (frame, key columns,
    date column) and the dates (days) at which they are cut: as many slices as
    the key holds times ``rows``.  None if there is no such key, or ``rows`` is None.

    One job counts rows per key (combined before the shuffle); at most one key for
    each ``rows`` rows is heavy.  Slices follow the key's own dates, so neither a
    stray date nor a key whose rows lie in one year makes uneven or endless slices.
    Rows of one key and one date stay together.  The answer is remembered within
    the application; only found heavy keys are stored.
    """
    if rows is None:
        return None
    days = reduce(DataFrame.unionByName, [
        df.select(key_struct(keys).alias(KEY), F.unix_date(F.col(date).cast("date")).alias("__day"))
        for df, keys, date in inputs])

    def find() -> DataFrame | None:
        heavy = days.groupBy(KEY).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)
        if heavy.isEmpty():
            return None
        marks = [i / _FINEST for i in range(1, _FINEST)]
        k = F.least(F.lit(_FINEST), F.ceil(F.col("__n") / rows)).cast("int")
        picked = F.transform(F.sequence(F.lit(1), k - 1), lambda i: F.element_at(
            "__marks", F.greatest(F.lit(1), (i * _FINEST / k).cast("int"))))
        cuts = (days.join(heavy, KEY).groupBy(KEY, "__n")
                .agg(F.percentile_approx("__day", marks, 10 * _FINEST).alias("__marks"))
                .select(KEY, F.when(F.col("__marks").isNotNull() & (k > 1), F.array_distinct(picked))
                        .otherwise(F.array().cast("array<int>")).alias(CUTS)))
        return materialize(cuts, "heavy")

    return remembered(days, f"heavy-{rows}", find)


def slice_of(date: Column, cuts: str = CUTS) -> Column:
    """Slice number of a non-NULL date: the cuts at or before it; 0 without cuts."""
    day = F.unix_date(date.cast("date"))
    return F.coalesce(F.size(F.filter(F.col(cuts), lambda c: c <= day)), F.lit(0)).cast("long")
