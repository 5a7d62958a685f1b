"""Sharding along a Hilbert curve.

Each metadata dimension is cut into 2^bits cells at approximate quantiles, the
cell numbers become one position on the curve, rows are ordered by it, and runs
of equal row counts are cut off as shards.  Rows close in all dimensions share a
shard, so the min/max statistics of its files prune on any of them.

Law: ``rows`` (shard sizes differ by one row at most).

Defined results.  Null dimension: the first cell.  Null text: no bytes.  Rows with
equal curve position: ordered by a hash of (id, crc32), then id.  Repeated rows
each get a slot.  Fewer rows than shards: some shards stay empty.  Empty table:
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import cut, number_in_group, packed, unpacked

BITS = 6
#: Rows of one curve position are dealt over so many hash ranges, so that a
#: position holding a third of the table is numbered by many tasks.
SALTS = 64


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve positions of the rows of ``cells`` (n rows, one column a dimension):
    undo excess work from the top bit down, Gray encode, interleave the bits."""
    x = [cells[:, d].astype(np.int64).copy() for d in range(cells.shape[1])]
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for d in range(n):
            flip = (x[d] & high) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    carry = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        carry = np.where((x[n - 1] & (1 << bit)) != 0, carry ^ ((1 << bit) - 1), carry)
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(n):
            out = (out << 1) | (((x[d] ^ carry) >> bit) & 1)
    return out


def _ordinals(df: DataFrame, dims: list[str]) -> list[Column]:
    """Order-preserving doubles: numbers as they are, texts by the six bytes that
    follow the prefix shared by the smallest and the largest value."""
    texts = [d for d in dims if dict(df.dtypes)[d] in ("string", "binary")]
    ends = df.agg(*[f(F.col(d).cast("string")).alias(f"{n}{i}") for i, d in enumerate(texts)
                    for n, f in (("lo", F.min), ("hi", F.max))]).head() if texts else None
    out = []
    for d in dims:
        if d not in texts:
            kind = dict(df.dtypes)[d]
            c = F.col(d).cast("long") if kind in ("date", "timestamp", "boolean") else F.col(d)
            out.append((F.unix_date(d) if kind == "date" else c).cast("double"))
            continue
        i = texts.index(d)
        lo, hi = (ends[f"lo{i}"] or "").encode(), (ends[f"hi{i}"] or "").encode()
        same = next((k for k, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
        six = F.rpad(F.hex(F.substring(F.encode(F.col(d).cast("string"), "UTF-8"), same + 1, 6)), 12, "0")
        out.append(F.when(F.col(d).isNotNull(), F.conv(six, 16, 10).cast("double")))
    return out


def curve(df: DataFrame, dims: list[str], keep: list[Column], bits: int = BITS) -> DataFrame:
    """``keep`` plus ``h``, the curve position of each row's ``dims``."""
    names = [f"_d{i}" for i in range(len(dims))]
    rows = df.select(*keep, *[c.alias(n) for c, n in zip(_ordinals(df, dims), names)])
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(n, shares, 10000).alias(n) for n in names]).head()
    edges = [np.unique(np.array(cuts[n] or [], dtype=float)) for n in names]

    @F.pandas_udf("long")
    def place(*dims: pd.Series) -> pd.Series:
        cells = np.zeros((len(dims[0]), len(dims)), dtype=np.int64)
        for i, d in enumerate(dims):
            v = d.to_numpy(dtype=float, na_value=np.nan)
            at = np.searchsorted(edges[i], v, side="right")
            cells[:, i] = np.where(np.isnan(v), 0, np.minimum(at, (1 << bits) - 1))
        return pd.Series(hilbert_index(cells, bits))

    return rows.withColumn("h", place(*names)).drop(*names)


def positions(rows: DataFrame, key: str, tie: list[str], coarse_bits: int = 12) -> DataFrame:
    """``rows`` (with ``h``) plus ``pos``, gapless from 0 along the curve.

    Cells (h, salt) are counted first; offsets are summed in two levels (ranges of
    the curve, then cells inside a range), so no window holds the table.
    """
    rows = cut(rows.withColumn("_salt", F.pmod(F.xxhash64(F.lit(11), key, *tie), F.lit(SALTS))))
    cells = cut(rows.groupBy("h", "_salt").agg(F.count(F.lit(1)).alias("_n"))
                .withColumn("_range", F.shiftright("h", coarse_bits)))
    past = (Window.unboundedPreceding, -1)
    ranges = cells.groupBy("_range").agg(F.sum("_n").alias("_m")).select(
        "_range", F.coalesce(F.sum("_m").over(Window.orderBy("_range").rowsBetween(*past)), F.lit(0)).alias("_r0"))
    inside = Window.partitionBy("_range").orderBy("h", "_salt").rowsBetween(*past)
    cells = cells.withColumn("_c0", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(ranges, "_range").select(
        "h", "_salt", (F.col("_r0") + F.col("_c0")).alias("_0"))
    order = Window.partitionBy("h", "_salt").orderBy(F.col(key).asc_nulls_first(), *tie)
    return rows.join(cells, ["h", "_salt"]).withColumn(
        "pos", F.col("_0") + F.row_number().over(order) - 1).drop("_0", "_salt")


def shard(df: DataFrame, dims: list[str], shards: int = 16, key: str = "doc_id",
          text: str = "text", bits: int = BITS, within: str | None = None) -> DataFrame:
    """(key, size, text_crc32, h, shard, slot) of every row, cut into ``shards``
    runs of the curve; ``slot`` counts from 0 inside a shard, along the curve or in
    the order of ``within``: a column of places from 0 below the row count, none of them
    null, which is then returned too."""
    utf8 = F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))
    keep = [F.col(key).alias("_key"), (F.octet_length(utf8) + 1).cast("long").alias("size"),
            F.crc32(utf8).alias("text_crc32"), *([F.col(within).alias("_within")] if within else [])]
    rows = positions(cut(curve(df, dims, keep, bits)), "_key", ["text_crc32", "size"])
    total = rows.count()
    # Shard s takes the positions [ceil(s * total / shards), ceil((s + 1) * total / shards)).
    at = F.expr(f"cast(pos * {shards}L div {max(total, 1)}L as int)")
    if within:
        # Places spread over the numbers of 62 bits, so that a shard is numbered by many tasks.
        spread = rows.withColumn("shard", at).withColumn("_place", F.col("_within") * F.lit((1 << 62) // max(total, 1)))
        return number_in_group(spread, ["shard"], "_place", ["_key", "text_crc32"], "slot") \
            .select(F.col("_key").alias(key), "size", "text_crc32", "h", "shard", "slot", F.col("_within").alias(within))
    first = F.ceil(F.col("shard").cast("decimal(20,0)") * total / F.lit(shards)).cast("long")
    return rows.withColumn("shard", at).withColumn("slot", F.col("pos") - first) \
        .select(F.col("_key").alias(key), "size", "text_crc32", "h", "shard", "slot")


def write_shards(df: DataFrame, placed: DataFrame, path: str, place: str) -> None:
    """Write the rows of ``df`` as one folder a shard, ordered along the curve.  ``place``
    numbers the rows of both frames, each once (``mix_pos``), so that neither null nor
    repeated ids lose a row."""
    where = placed.select(F.col(place).alias("_place"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"), F.col("h").alias("_h"))
    rows = packed(df, _at=F.col(place)).join(where, F.col("_at") == F.col("_place"))
    rows.repartition("_shard", F.floor(F.col("_slot") / 100_000)).sortWithinPartitions("_shard", "_h", "_slot") \
        .select(*unpacked(rows, [c for c in df.columns if c != "shard"]), F.col("_shard").alias("shard")) \
        .write.partitionBy("shard").parquet(path)
