"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytrail.config import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The whole row of ``df`` as the struct ``row`` and the ``named`` columns beside it,
    so that no column of the input can clash with a working name."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, columns: list[str]) -> list[Column]:
    """The given columns of ``row``."""
    return [F.col("row")[c].alias(c) for c in columns]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Spark goes on with the estimated size of ``df``, and estimates a join as the product of
    its sides: where one cut table is joined to make the next, the digits of the estimate
    double each time, up to numbers of megabytes in every node of every plan.  From 64 bits
    on the size counts as unknown (``spark.sql.defaultSizeInBytes``); rows, partitioning and
    order stay.
    """
    checkpoint_root(df.sparkSession)
    out = df.checkpoint()
    plan = out._jdf.queryExecution().logical()
    if plan.stats().sizeInBytes() < 2**63:
        return out
    jvm, session = df.sparkSession._jvm, out._jdf.sparkSession()
    option = jvm.scala.Option
    plan = plan.copy(plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(),
                     plan.stream(), session, option.empty(), option.apply(plan.constraints()))
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, plan), df.sparkSession)


def bucket(col: Column | str, n: int) -> Column:
    """Remainder of crc32 of the id as text; a null id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit(""))), F.lit(n))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``): rows (``node``, ``root``)
    with the smallest node of each component as root.

    Each round every node points to its smallest neighbour, if that is smaller; pointers
    are followed to their ends, jumping to the pointer's own pointer, so long chains halve
    per jump.  The ends, half of the nodes at most, are the nodes of the next round, and
    the edges between different ends its edges, so an edge is joined in few rounds however
    many edges a component has.  Tables are checkpointed; only the number of changed rows
    reaches the driver.
    """
    left = cut(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not rounds or not left.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError("components did not settle")
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = _ends(cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("root"))), max_rounds)
        rounds.append(ends)
        left = cut(left.join(ends.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                   .join(ends.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra != rb")
                   .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    labels = rounds.pop()
    while rounds:
        labels = rounds.pop().join(labels.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left") \
            .select("node", F.coalesce("top", "root").alias("root"))
    return cut(labels)


def _ends(pointers: DataFrame, max_rounds: int) -> DataFrame:
    """(node, root) with the last node of each chain of pointers; the last one points to itself."""
    for _ in range(max_rounds):
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = cut(pointers.join(up, "root").select("node", F.col("root").alias("old"), F.col("top").alias("root")))
        pointers = step.select("node", "root")
        if step.where("root < old").isEmpty():
            return pointers
    raise RuntimeError("components did not settle")


SALTS = 1024


def salted(rows: DataFrame, keys: list[str], by: str, salts: int = SALTS) -> DataFrame:
    """``rows`` shuffled on (keys, ``salt``), the salt being a hash of column ``by``."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).repartition(*keys, "salt")


def total_by_salt(parts: DataFrame, keys: list[str], totals: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Totals of whole groups, given back to every (keys, ``salt``) of ``parts``.

    ``parts`` holds one row for each (keys, salt), so at most a row for each salt meets
    per group, and a join of :func:`salted` rows on (keys, salt) needs no hot task.
    """
    w = Window.partitionBy(*keys)
    return parts.select(*keys, "salt", *[f(c).over(w).alias(c) for c, f in totals.items()])


def number_in_group(df: DataFrame, group: list[str], key: str, tie: list[str],
                    out: str, bits: int = 10) -> DataFrame:
    """Gapless row numbers from 0 within ``group`` in the order of the hash ``key``.

    A group of any size is dealt over ``2 ** bits`` ranges of the hash; ranges are
    counted first (map-side combined), so each range only needs its own offset.
    """
    cell = F.shiftrightunsigned(F.col(key), 64 - bits)
    rows = df.withColumn("_cell", cell)
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        *group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_cell").orderBy(key, *tie)
    return rows.join(offsets, [*group, "_cell"]).withColumn(
        out, F.col("_before") + F.row_number().over(inside) - 1).drop("_cell", "_before")
