"""A stored history that follows its tables: only the periods of changed employees are
made again, and only the buckets that hold these are written.

Each version of the store keeps a digest for every employee (of the title, salary and
department rows) and for every department (of its name and its managers' periods).  A
refresh compares them with the digests of the tables as they are now: an employee
has changed if the own digest has, or that of a department the employee was in.

Nothing is written over.  A version writes its buckets and digests to a folder of its
own and then, last of all, the list of buckets with the version that holds each; a
refresh that was cut short leaves a folder without such a list, which is not read.
Folders of earlier versions stay until the caller removes them.  One refresh of a store
runs at a time.

Defined results.  First refresh: all employees are new.  Nothing changed: no new version.
Employees that are gone: their periods go.  Equal rows count, their order does not.  Rows
without an employee: not part of any period.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.operators.joins import beside, materialize
from paytrail.operators.tables import FACTS
from paytrail.operators.versions import folder_files
from paytrail.plans import history
from paytrail.plans.snapshot import manager_periods

BUCKETS = 256
_DIGEST = ["n", "sum", "xor"]


@dataclass(frozen=True)
class Refresh:
    version: int               # the version now to be read
    employees: int             # changed, new and gone employees
    buckets: tuple[int, ...]   # buckets written again


def _row_hash(name: str, columns: list[str]) -> Column:
    # A null is hashed as a value: xxhash64 by itself passes over nulls.
    return F.xxhash64(F.lit(name), *[F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in columns])


def digests(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(key, n, sum, xor): a digest of the rows of each key over all ``frames``
    (name -> frame and key column), whatever their order; combined before the shuffle."""
    rows = reduce(DataFrame.unionByName, [
        df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), _row_hash(name, df.columns).alias("h"),
                                                _row_hash(f"{name}, again", df.columns).alias("g"))
        for name, (df, key) in frames.items()])
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("sum"),
                                   F.bit_xor("g").alias("xor"))


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys that only one side has, or whose digests differ."""
    same = reduce(Column.__and__, [F.col(f"o.{c}").eqNullSafe(F.col(f"w.{c}")) for c in _DIGEST])
    return old.alias("o").join(new.alias("w"), F.col("o.key") == F.col("w.key"), "full_outer") \
        .where(~same).select(F.coalesce("o.key", "w.key").alias("key"))


class StoredHistory:
    """:func:`history.lagged_periods` stored below ``root`` in ``buckets`` of employees."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, bounds: str = "closed"):
        self.spark = spark
        self.buckets = buckets
        self.bounds = bounds
        self.root = f"{root.rstrip('/')}/{bounds}-{buckets}"

    def _path(self, version: int, part: str) -> str:
        return f"{self.root}/v{version:06d}/{part}"

    def _numbers(self, end: str = "") -> list[int]:
        found = (re.search(rf"/v(\d+)/.*{end}$", path) for path, _, _ in folder_files(self.spark, self.root))
        return sorted({int(m.group(1)) for m in found if m})

    def version(self) -> int | None:
        """The last version that was finished."""
        return max(self._numbers("places/_SUCCESS"), default=None)

    def _places(self, version: int) -> dict[int, int]:
        """The version that holds each bucket; one row a bucket."""
        return {r["bucket"]: r["version"] for r in self.spark.read.parquet(self._path(version, "places")).collect()}

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _rows(self, version: int, places: dict[int, int]) -> DataFrame:
        # An empty table keeps the schema, which a store without a row needs too.
        schema = self.spark.read.parquet(self._path(version, "empty")).schema
        paths = [self._path(v, f"periods/bucket={b}") for b, v in sorted(places.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """All periods of the last finished version."""
        version = self.version()
        if version is None:
            raise ValueError(f"no finished version below {self.root}")
        return self._rows(version, self._places(version))

    def refresh(self, t: Mapping[str, DataFrame]) -> Refresh:
        """Bring the store to the tables ``t``."""
        before = self.version()
        after = max(self._numbers(), default=0) + 1
        departments = digests({"manager": (manager_periods(t), "department_id"), "department": (t["department"], "id")})
        employees = digests({n: (t[n], "employee_id") for n in FACTS})
        departments.write.parquet(self._path(after, "departments"))
        employees.write.parquet(self._path(after, "employees"))
        new = {n: self.spark.read.parquet(self._path(after, n)) for n in ("departments", "employees")}
        if before is None:
            old = {n: df.limit(0) for n, df in new.items()}
            places = {}
        else:
            old = {n: self.spark.read.parquet(self._path(before, n)) for n in new}
            places = self._places(before)
        touched = changed(old["departments"], new["departments"]).withColumnRenamed("key", "department_id")
        moved = t["department_employee"].join(beside(materialize(touched, "departments")), "department_id", "left_semi") \
            .where("employee_id is not null").select(F.col("employee_id").alias("key"))
        keys = materialize(changed(old["employees"], new["employees"]).union(moved).distinct()
                           .select(F.col("key").alias("employee_id")), "changed")
        counts = {r["bucket"]: r["count"] for r in keys.groupBy(self._bucket("employee_id").alias("bucket")).count().collect()}
        if not counts and before is not None:
            return Refresh(before, 0, ())

        some = t if before is None else {**t, **{n: t[n].join(beside(keys), "employee_id", "left_semi") for n in FACTS}}
        periods = history.lagged_periods(some, self.bounds)
        periods.limit(0).write.parquet(self._path(after, "empty"))
        if before is not None:
            kept = self._rows(before, {b: v for b, v in places.items() if b in counts})
            periods = kept.join(beside(keys), "employee_id", "left_anti").select(periods.columns).unionByName(periods)
        # Rebalanced, a bucket is one file if it is small; that of a heavy employee is split.
        periods.withColumn("bucket", self._bucket("employee_id")).hint("rebalance", "bucket") \
            .write.partitionBy("bucket").parquet(self._path(after, "periods"))
        written = {int(m.group(1)) for m in (re.search(r"/bucket=(\d+)/", path) for path, _, _ in
                                             folder_files(self.spark, self._path(after, "periods"))) if m}
        places = {b: v for b, v in places.items() if b not in counts} | {b: after for b in written}
        self.spark.createDataFrame(sorted(places.items()), "bucket int, version int").coalesce(1) \
            .write.parquet(self._path(after, "places"))
        return Refresh(after, sum(counts.values()), tuple(sorted(counts)))
