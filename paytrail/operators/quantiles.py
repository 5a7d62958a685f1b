"""Exact continuous quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.joins import materialize
from paytrail.operators.spread import PART, TIE, dealt, running
from paytrail.operators.versions import stored_bytes

WINDOW_BYTES = 32 << 20
_N, _UPTO, _ALL = "__n", "__upto", "__all"


def _small(df: DataFrame, window_bytes: int) -> bool:
    size = stored_bytes(df)
    return size is not None and size <= window_bytes


def value_counts(df: DataFrame, keys: Sequence[str], value: str, sums: Mapping[str, Column] | None = None,
                 window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """One row for each (keys, value): its rows in ``__n`` and the ``sums``.  Combined
    before the shuffle, which deals a group over its values.  Stored, unless the input
    itself is small."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(_N), *[c.alias(n) for n, c in (sums or {}).items()])
    return counts if _small(df, window_bytes) else materialize(counts, "counts")


def _with_totals(ranked: DataFrame, counts: DataFrame, keys: Sequence[str], rows: Column, few: bool) -> DataFrame:
    """``ranked`` with the rows of its whole group."""
    if few:
        return ranked.withColumn(_ALL, F.sum(rows).over(Window.partitionBy(*keys)))
    whole = counts.groupBy(*keys).agg(F.sum(rows).alias(_ALL))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}"))
    return ranked.alias("r").join(whole.alias("g"), same).select(*[F.col(f"r.{c}") for c in ranked.columns], _ALL)


def exact_quantiles(counts: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float],
                    more: Sequence[Column] = (), window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """Per group the continuous quantiles (linear between the two neighbouring ranks)
    of ``value``, by name, and the ``more`` aggregates, from :func:`value_counts`.

    The counts are totalled along the values, so every row knows the ranks that its
    value takes; the two ranks of a quantile are picked by a partial aggregate.  Counts
    from more than ``WINDOW_BYTES`` of files are dealt along (keys, value) and totalled from
    range to range, so that no task holds all values of a group; fewer take one window.
    NULL values are skipped.
    """
    order = [F.col(k) for k in keys] + [F.col(value)]
    rows = F.when(F.col(value).isNotNull(), F.col(_N)).otherwise(F.lit(0))
    few = _small(counts, window_bytes)
    if few:
        ranked = counts.withColumn(_UPTO, F.sum(rows).over(Window.partitionBy(*keys).orderBy(value)))
    else:
        ranked = running(dealt(counts, order), keys, order, rows, _UPTO).drop(PART, TIE)
    ranked = _with_totals(ranked, counts, keys, rows, few)
    first, last = F.col(_UPTO) - rows, F.col(_UPTO) - 1  # ranks from 0

    def at(rank: Column) -> Column:
        return F.max(F.when((rows > 0) & (first <= rank) & (rank <= last), F.col(value).cast("double")))

    picked, out = [], []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col(_ALL) - 1)
        low, high = F.floor(place), F.ceil(place)
        picked += [at(low).alias(f"__low_{name}"), at(high).alias(f"__high_{name}"),
                   F.max(place - low).alias(f"__part_{name}")]
        lo, hi, part = F.col(f"__low_{name}"), F.col(f"__high_{name}"), F.col(f"__part_{name}")
        out.append(F.when(lo == hi, lo).otherwise((1 - part) * lo + part * hi).alias(name))
    grouped = ranked.groupBy(*keys).agg(*picked, *more)
    return grouped.select("*", *out).drop(*[f"__{x}_{n}" for n in probabilities for x in ("low", "high", "part")])
