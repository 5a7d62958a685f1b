"""Profiling and data-quality operators.

Everything here is an aggregation with map-side combining, so hot keys are
pre-aggregated before any shuffle; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.config import OPEN_END


def records_per_key(df: DataFrame, key: str, value: str | None = None, distinct: bool = False,
                    out: str = "employees_with_record_value") -> DataFrame:
    """Cardinality histogram: how many keys have 1, 2, ... records.

    ``value=None`` counts rows, otherwise non-null ``value`` entries
    (``distinct=True``: distinct entries).
    """
    if value is None:
        n = F.count(F.lit(1))
    elif distinct:
        n = F.countDistinct(value)
    else:
        n = F.count(value)
    per_key = df.groupBy(key).agg(n.alias("record_value"))
    return per_key.groupBy("record_value").agg(F.count(F.lit(1)).alias(out))


def distinct_count(df: DataFrame, col: str, out: str = "distinct_count") -> DataFrame:
    return df.agg(F.countDistinct(col).alias(out))


def latest_dates(df: DataFrame, date_col: str = "to_date", key: str = "employee_id",
                 n: int = 5) -> DataFrame:
    """Records and distinct keys per date, latest ``n`` dates (DESC NULLS FIRST)."""
    return (df.groupBy(date_col)
            .agg(F.count(F.lit(1)).alias("record_count"), F.countDistinct(key).alias("employee_count"))
            .orderBy(F.col(date_col).desc_nulls_first())
            .limit(n))


def key_violations(tables: dict[str, DataFrame],
                   keys: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """One row per declared unique key: groups and rows sharing a key value.
    Rows with a NULL key part are exempt, as in a unique index."""
    parts = []
    for table, cols in keys:
        df = tables[table]
        for c in cols:
            df = df.filter(F.col(c).isNotNull())
        dup = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                             F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"))
                     .select(F.lit(table).alias("table_name"),
                             F.lit(",".join(cols)).alias("key_columns"),
                             "duplicate_keys", "duplicate_rows"))
    return reduce(DataFrame.unionByName, parts)


def relationship(df: DataFrame, name: str, key: str, value: str | None = None,
                 distinct: bool = False) -> DataFrame:
    """``1:1`` when no key has more than one record, else ``1:many``."""
    hist = records_per_key(df, key, value, distinct)
    return hist.agg(F.max("record_value").alias("max_records")).select(
        F.lit(name).alias("relation"), F.lit(key).alias("key_column"), "max_records",
        F.when(F.col("max_records") > 1, F.lit("1:many")).otherwise(F.lit("1:1"))
        .alias("relationship"))


def reconcile_counts(tables: dict[str, DataFrame], snapshot: DataFrame) -> DataFrame:
    """Distinct employees per table, open records and open employees per SCD
    table, and the snapshot's rows: they should tell one consistent story."""
    rows = [tables["employee"].agg(
        F.lit("employee").alias("relation"),
        F.countDistinct("id").alias("distinct_employees"),
        F.lit(None).cast("long").alias("current_records"),
        F.lit(None).cast("long").alias("current_employees"))]
    for name in ("salary", "title", "department_employee"):
        each = _per_key(tables[name], "employee_id")
        known = F.col("employee_id").isNotNull()
        rows.append(each.agg(
            F.lit(name).alias("relation"),
            F.count("employee_id").alias("distinct_employees"),
            F.coalesce(F.sum("open_rows"), F.lit(0)).cast("long").alias("current_records"),
            F.count(F.when(known & (F.col("open_rows") > 0), F.lit(1))).alias("current_employees")))
    rows.append(snapshot.agg(
        F.lit("current_employee_snapshot").alias("relation"),
        F.countDistinct("employee_id").alias("distinct_employees"),
        F.count(F.lit(1)).alias("current_records"),
        F.countDistinct("employee_id").alias("current_employees")))
    return reduce(DataFrame.unionByName, rows)


def _per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows and open rows of each key: one map-side combined aggregate."""
    is_open = F.col("to_date") == F.lit(OPEN_END)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("all_rows"),
                               F.count(F.when(is_open, F.lit(1))).alias("open_rows"))


def former_records(df: DataFrame, key: str = "employee_id") -> DataFrame:
    """Number of records of keys that have no open record (a NULL key never has one)."""
    gone = F.col(key).isNull() | (F.col("open_rows") == 0)
    return _per_key(df, key).agg(
        F.coalesce(F.sum(F.when(gone, F.col("all_rows"))), F.lit(0)).cast("long").alias("record_count"))
