"""Staging: the repaired copies of the six tables (all dates +18 years, the
open end kept) and the warehouse that stores raw and staged tables as parquet
under the cluster's checkpoint folder."""

from __future__ import annotations

import hashlib
import inspect
import threading
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail.config import OPEN_END, SHIFT_YEARS, checkpoint_root
from paytrail.functions.dates import add_years, shift_date
from paytrail.operators import sequence, slices
from paytrail.operators.joins import materialize
from paytrail.operators.tables import FACTS, Tables, heavy_employees, split_heavy
from paytrail.operators.versions import folder_files, folder_version, frame_version
from paytrail.sources import fixtures, schemas

_LOCK = threading.RLock()

OPEN = "open"  # partition of the facts: true for rows still valid
BUCKET_BYTES = 1 << 30

TABLES = ("department", "department_employee", "department_manager", "employee", "salary", "title")


def _source_tables(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    if source.startswith("catalog:"):
        return {n: spark.table(f"{source.removeprefix('catalog:')}.{n}") for n in TABLES}
    return {n: spark.read.parquet(f"{source.rstrip('/')}/{n}") for n in TABLES}


def _lost(df: DataFrame, schema: T.StructType) -> Column:
    """The columns whose value does not fit the type of ``schema``."""
    return F.array_compact(F.array(*[F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                                     for f in schema]))


def read_tables(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """The six raw tables of ``source``: a folder with one parquet table each
    (``<folder>/employee`` ...), or ``catalog:<database>`` for catalog tables.
    Columns are taken by name, others are ignored.  Keys keep the type that the source
    gives them (see :func:`schemas.negotiated`), other columns get the declared type.  Rows
    with a value that does not fit its type are left out; :func:`rejected_rows` has them."""
    found = _source_tables(spark, source)
    wanted = schemas.negotiated({n: df.schema for n, df in found.items()})
    return {n: df.where(F.size(_lost(df, wanted[n])) == 0).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted[n]]) for n, df in found.items()}


def rejected_rows(spark: SparkSession, source: str) -> DataFrame:
    """(table_name, columns, row): each row that :func:`read_tables` leaves out, as JSON,
    with the columns whose values do not fit."""
    found = _source_tables(spark, source)
    wanted = schemas.negotiated({n: df.schema for n, df in found.items()})
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(n).alias("table_name"), _lost(df, wanted[n]).alias("columns"),
                  F.to_json(F.struct(*[F.col(f.name) for f in wanted[n]])).alias("row")).where(F.size("columns") > 0)
        for n, df in found.items()])


def stage_table(name: str, df: DataFrame, years: int = SHIFT_YEARS) -> DataFrame:
    """The repaired copy of one raw table."""
    if name == "department":
        return df.select("id", "dept_name")
    if name == "employee":
        return df.select("id", add_years("birth_date", years).alias("birth_date"),
                         "first_name", "last_name", "gender",
                         add_years("hire_date", years).alias("hire_date"))
    if name in ("department_employee", "department_manager"):
        payload = ["employee_id", "department_id"]
    elif name == "salary":
        payload = ["employee_id", "amount"]
    elif name == "title":
        payload = ["employee_id", "title"]
    else:
        raise KeyError(name)
    return df.select(*payload, add_years("from_date", years).alias("from_date"),
                     shift_date("to_date", years).alias("to_date"))


def stage(raw: dict[str, DataFrame], years: int = SHIFT_YEARS) -> dict[str, DataFrame]:
    return {t: stage_table(t, raw[t], years) for t in TABLES}


def _version() -> str:
    """Stored tables are keyed by the code that derives them."""
    h = hashlib.sha1()
    for mod in (fixtures, schemas, sequence, slices):
        h.update(inspect.getsource(mod).encode())
    h.update(inspect.getsource(stage_table).encode() + inspect.getsource(Warehouse).encode())
    return h.hexdigest()[:12]


def _exists(spark: SparkSession, path: str) -> bool:
    return next(folder_files(spark, path), None) is not None


class Warehouse:
    """Raw and staged tables of one input, written once as parquet for each version of it.

    Reading the stored copies instead of re-deriving them keeps the lineage
    short (a lost executor recomputes from parquet, not from the orders table).
    The staged employee table and the three facts are clustered (bucketed) by employee,
    so that joins and windows on that key read them without a shuffle; the facts have
    a partition of open rows, which the snapshot reads alone.  Employees with more than
    ``HEAVY_ROWS`` rows would make a bucket that one task must read: their facts are
    stored apart, dealt by (employee, start date).
    """

    def __init__(self, spark: SparkSession, source: str, root: str | None = None,
                 tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.source = source.rstrip("/")
        self.given = tables
        own = self._tables()
        # Keys have the types that the given tables give them.
        self.schemas = schemas.SCHEMAS if own is None else {
            n: T.StructType([own[n].schema[c] for c in schemas.SCHEMAS[n].fieldNames()]) for n in TABLES}
        self.version = self.input_version()
        if root is None:
            tag = hashlib.sha1(self.source.encode()).hexdigest()[:10]
            # One warehouse per application: concurrent jobs never write into
            # each other's folders.
            app = spark.sparkContext.applicationId
            root = f"{checkpoint_root(spark)}/paytrail-warehouse/{app}/{tag}-{_version()}-{self.version}"
            if tables is not None:  # given frames may have no files to tell them apart
                root = f"{root}-{uuid.uuid4().hex[:8]}"
        self.root = root
        self._built = False

    def _tables(self) -> dict[str, DataFrame] | None:
        """The six raw tables, where the source names them."""
        if self.given is not None:
            return self.given
        return read_tables(self.spark, self.source.removeprefix("tables:")) if self.source.startswith("tables:") else None

    def input_version(self) -> str:
        """Version of the files that the tables are made from, as they are now."""
        tables = self._tables()
        if tables is None:
            return folder_version(self.spark, [f"{self.source}/{t}.parquet" for t in fixtures.DRIVER_TABLES])
        return hashlib.sha1("".join(frame_version(tables[n]) for n in TABLES).encode()).hexdigest()[:16]

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def build(self, force: bool = False) -> None:
        with _LOCK:  # queries running on several driver threads build it once
            self._build(force)

    def _build(self, force: bool) -> None:
        if not force and (self._built or _exists(self.spark, f"{self.root}/_COMPLETE")):
            self._built = True
            return
        if _exists(self.spark, f"{self.root}/_COMPLETE"):
            # A finished build is never written over: a forced one gets a folder of its own.
            self.root = f"{self.root}-{uuid.uuid4().hex[:8]}"
        if self.source.startswith("tables:"):
            rejected_rows(self.spark, self.source.removeprefix("tables:")).write.mode("overwrite").parquet(self._path("quality", "rejected"))
        raw = self._tables() or fixtures.derive_raw(fixtures.read_driver_tables(self.spark, self.source),
                                                    materialize=lambda df: materialize(df, "fixture"))
        for name in TABLES:
            df = raw[name].sortWithinPartitions("to_date", "employee_id") if name in schemas.SCD_TABLES else raw[name]
            df.write.mode("overwrite").parquet(self._path("raw", name))
        staged = stage(self._raw())
        heavy = heavy_employees(staged)
        if heavy is not None:
            heavy.write.mode("overwrite").parquet(self._path("heavy", "keys"))
        buckets = self._buckets()
        for name, df in staged.items():
            if name in FACTS and heavy is not None:
                df, apart = split_heavy(df, heavy)
                apart.repartitionByRange("employee_id", "from_date").write.mode("overwrite").parquet(self._path("heavy", name))
            if name in FACTS or name == "employee":
                self._cluster(df, name, buckets)
            else:
                df.write.mode("overwrite").parquet(self._path("staged", name))
        self.spark.createDataFrame([("ok",)], "s string").coalesce(1) \
            .write.mode("overwrite").text(f"{self.root}/_COMPLETE")
        self._built = True

    def _buckets(self) -> int:
        """Buckets of about ``BUCKET_BYTES``; at least one for each core."""
        size = sum(f[1] for f in folder_files(self.spark, f"{self.root}/raw"))
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        return min(most, max(self.spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES)))

    def _table_name(self, name: str) -> str:
        return f"paytrail_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}_{name}"

    def _cluster(self, df: DataFrame, name: str, buckets: int) -> None:
        """Write one file for each bucket (and each partition of a fact)."""
        key, order = ("id", ["id"]) if name == "employee" else ("employee_id", ["employee_id", "from_date"])
        if name in FACTS:
            df = df.withColumn(OPEN, F.coalesce(F.col("to_date") == F.lit(OPEN_END), F.lit(False)))
        w = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(*order)
        w = w.partitionBy(OPEN) if name in FACTS else w
        w.option("path", self._path("staged", name)).saveAsTable(self._table_name(name))

    def _clustered(self, name: str) -> DataFrame:
        """The stored table by its catalog entry; one built by another application is read by path."""
        if self.spark.catalog.tableExists(self._table_name(name)):
            return self.spark.table(self._table_name(name))
        return self.spark.read.parquet(self._path("staged", name))

    def _raw(self) -> dict[str, DataFrame]:
        return {n: self.spark.read.schema(self.schemas[n]).parquet(self._path("raw", n)) for n in TABLES}

    def rejected(self) -> DataFrame:
        """The rows of ``tables:SOURCE`` that are left out (see :func:`rejected_rows`)."""
        self.build()
        return self.spark.read.parquet(self._path("quality", "rejected"))

    def raw(self) -> dict[str, DataFrame]:
        self.build()
        return self._raw()

    def staged(self) -> Tables:
        self.build()
        columns = {n: self.schemas[n].fieldNames() for n in TABLES}
        frames = {n: self.spark.read.schema(self.schemas[n]).parquet(self._path("staged", n))
                  for n in TABLES if n not in FACTS and n != "employee"}
        whole = {n: self._clustered(n) for n in (*FACTS, "employee")}
        frames |= {n: df.select(columns[n]) for n, df in whole.items()}
        ordinary = Tables(frames, {n: whole[n].where(OPEN).select(columns[n]) for n in FACTS})
        if not _exists(self.spark, self._path("heavy", "keys")):
            return ordinary
        keys = self.spark.read.parquet(self._path("heavy", "keys"))
        apart = {n: self.spark.read.schema(self.schemas[n]).parquet(self._path("heavy", n)) for n in FACTS}
        united = {n: df.unionByName(apart[n]) if n in FACTS else df for n, df in frames.items()}
        return Tables.united(united, [ordinary, Tables({**frames, **apart}, heavy=keys)])


_CACHE: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str, root: str | None = None,
              tables: dict[str, DataFrame] | None = None) -> Warehouse:
    """The warehouse of ``sf_dir`` for this session; ``root`` replaces it with
    one stored elsewhere (e.g. a fresh folder per benchmark run), ``tables``
    (see :func:`read_tables`) with one of the given raw tables; ``sf_dir`` is then
    only the name under which queries find it.  ``tables:SOURCE`` names six tables
    that are read from SOURCE.  A source whose files have changed gets a new warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if root is not None or tables is not None or key not in _CACHE:
            _CACHE[key] = Warehouse(spark, sf_dir, root, tables)
        elif _CACHE[key].input_version() != _CACHE[key].version:
            known = None if sf_dir.startswith("tables:") else _CACHE[key].given
            _CACHE[key] = Warehouse(spark, sf_dir, tables=known)
        return _CACHE[key]
