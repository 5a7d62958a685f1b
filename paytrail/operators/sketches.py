"""Mergeable sketches: distinct counts and quantiles from one pass, united upwards.

A sketch is a binary value of bounded size, so a group of any size is combined before
the shuffle, and a coarser level is made from the sketches of a finer one instead of
from the rows.  Estimates are approximate; both errors depend on the size parameter
alone.  NULL values are skipped; a group without values has the estimate 0, and NULL as
its quantiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = "sketch"
LG_REGISTERS = 14
KLL_SIZE = 800


def distinct_error(lg: int = LG_REGISTERS) -> float:
    """Relative standard error of a united distinct count: 0.8 % with 2 ** 14 registers."""
    return 1.04 / sqrt(2 ** lg)


def rank_error(size: int = KLL_SIZE) -> float:
    """Rank error of a quantile, as a share of the group's rows, that 99 % of quantiles keep: 0.6 % at 800."""
    return 2.296 / size ** 0.9021


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg: int = LG_REGISTERS) -> DataFrame:
    """One HyperLogLog sketch of ``value`` for each group."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg).alias(SKETCH))


def united_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of the coarser groups ``keys``."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def distinct_estimate(sketch: str | Column = SKETCH) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, size: int = KLL_SIZE) -> DataFrame:
    """One KLL sketch of the integer column ``value`` for each group."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), size).alias(SKETCH))


def united_quantiles(sketches: DataFrame, keys: Sequence[str], size: int = KLL_SIZE) -> DataFrame:
    """The sketches of the coarser groups ``keys``."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint(SKETCH, size).alias(SKETCH))


def quantile_columns(probabilities: Mapping[str, float], sketch: str = SKETCH) -> list[Column]:
    """The named quantiles of a sketch: values that occur in the group."""
    filled = F.kll_sketch_get_n_bigint(sketch) > 0
    return [F.when(filled, F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(p)))).alias(name)
            for name, p in probabilities.items()]
