"""Versions of stored input: which files there are, how long they are and when they
were written.  Stored intermediates carry the version of what they were made from."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many files are looked up from the driver, folder by folder; more by a Spark job.
LISTED_FILES = 2000

File = tuple[str, int, int]
_PATH: dict = {}


def _file_system(spark: SparkSession, path: str):
    # One look-up of the class for each gateway: every package of the name is a round trip.
    if _PATH.get("jvm") is not spark._jvm:
        _PATH.update(jvm=spark._jvm, cls=spark._jvm.org.apache.hadoop.fs.Path)
    p = _PATH["cls"](path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _entry(status) -> File:
    return status.getPath().toString(), status.getLen(), status.getModificationTime()


def folder_files(spark: SparkSession, path: str) -> Iterator[File]:
    """(path, length, modification time) of every file below ``path``; none if it does not exist."""
    p, fs = _file_system(spark, path)
    if fs.exists(p):
        found = fs.listFiles(p, True)
        while found.hasNext():
            yield _entry(found.next())


def _digest(files: Iterable[File]) -> str:
    return hashlib.sha1(repr(sorted(files)).encode()).hexdigest()[:16]


def folder_version(spark: SparkSession, paths: Iterable[str]) -> str:
    return _digest(f for path in paths for f in folder_files(spark, path))


def frame_files(df: DataFrame) -> list[File] | None:
    """The files that ``df`` reads, as they are now; None if there are more than ``LISTED_FILES``."""
    spark, paths = df.sparkSession, list(df.inputFiles())
    if len(paths) > LISTED_FILES:
        return None
    wanted: dict[str, set[str]] = {}
    for path in paths:
        folder, name = unquote(path).rsplit("/", 1)
        wanted.setdefault(folder, set()).add(name)
    out = []
    for folder, names in wanted.items():
        p, fs = _file_system(spark, folder)
        if fs.exists(p):
            out += [_entry(s) for s in fs.listStatus(p) if s.getPath().getName() in names]
    return out


def frame_version(df: DataFrame) -> str:
    """Version of the files that ``df`` reads.  Frames without files (local rows,
    checkpoints) have one version: they never change."""
    files = frame_files(df)
    if files is not None:
        return _digest(files)
    listed = df.sparkSession.read.format("binaryFile").load(list(df.inputFiles())).select("path", "length", "modificationTime")
    one = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.sum(
        F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("sum")).head()
    return hashlib.sha1(repr(tuple(one)).encode()).hexdigest()[:16]


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that ``df`` reads; None if unknown (no files, or very many)."""
    files = frame_files(df)
    return sum(size for _, size, _ in files) if files else None
