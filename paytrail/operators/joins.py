"""Stored intermediates and joins with small tables."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.config import checkpoint_root
from paytrail.operators.versions import frame_version, stored_bytes

T = TypeVar("T")
#: Most results remembered at once; the one used longest ago is forgotten first.
MOST_KNOWN = 256
#: Stored tables up to this size are broadcast; larger ones join by shuffle.
BROADCAST_BYTES = 4 << 20
_KNOWN: OrderedDict[tuple[str, str, int], tuple[DataFrame, str, object]] = OrderedDict()


def remembered(df: DataFrame, label: str, make: Callable[[], T]) -> T:
    """``make()``, called once within the application for every plan that computes
    the same as ``df`` from the same files.

    The version of the input files (paths, lengths, modification times) is taken at
    every call: once a table has been written over, the next call makes the result anew.
    """
    key = (df.sparkSession.sparkContext.applicationId, label, df.semanticHash())
    version = frame_version(df)
    known = _KNOWN.get(key)
    if known is not None and known[1] == version and known[0].sameSemantics(df):
        _KNOWN.move_to_end(key)
        return known[2]
    result = make()
    _KNOWN[key] = (df, version, result)
    _KNOWN.move_to_end(key)
    while len(_KNOWN) > MOST_KNOWN:
        _KNOWN.popitem(last=False)
    return result


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as parquet under the cluster's checkpoint folder and read it
    back: the lineage is cut (a lost executor recomputes from the stored files) and
    joins see the stored size, by which Spark chooses their strategy."""
    path = f"{checkpoint_root(df.sparkSession)}/paytrail-steps/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_once(df: DataFrame, label: str = "step") -> DataFrame:
    """:func:`materialize`, with one stored copy for the same plan over the same files."""
    return remembered(df, label, lambda: materialize(df, label))


def beside(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if the files it reads hold at most ``limit`` bytes,
    so that the other side of a join stays where it is; beyond that Spark chooses."""
    size = stored_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df
