"""Filter interaction audit by failing-id relations.

One id table is stored per filter, with the ids of the documents that fail it.  The
documents then pass the filters' tables one after the other: a left-semi join takes the
documents that fail the filter, a left-anti join those that pass.  After all filters
every document is in the relation of exactly the filters that it fails.  What survives
a prefix of an order went through the anti-join of each of its filters, what the next
filter removes went through its semi-join as well, and what it finds already gone went
through its semi-join and that of an earlier filter.  So every prefix of all orders is
counted from the sizes of these relations, and each document is joined once per filter
rather than once per prefix.

A document's id in these tables is its key with a hash of its text, so that null and
repeated keys stay apart.  Only counts by (part, relation) reach the order tables.

Defined results.  Null text: the empty text.  Null part: ''.  Rows without key never
count as later copies, nor make others so.  Repeated rows count each.  Several labels
of one key: the largest of each kind; no label: neither good nor toxic.  Empty table:
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paytrail.llm.common import cut, salted, total_by_salt

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_WHITE = "[\\x20\\x09-\\x0D]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, _WHITE, -1), lambda w: w != "")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of one text and its words, by filter name."""
    n = F.size(words).cast("long")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n,
            "C": 100 * capitals > 3 * F.char_length(text).cast("long"), "D": text.rlike("[#$%&*|]")}


def later_copies(rows: DataFrame) -> DataFrame:
    """The rows (``id``, ``t1``, ``t2``) whose text a smaller id has, too."""
    known = salted(rows.where(F.col("id").isNotNull()).select("id", "t1", "t2"), ["t1", "t2"], "id")
    parts = known.groupBy("t1", "t2", "salt").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    groups = total_by_salt(parts, ["t1", "t2"], {"n": F.sum, "first": F.min}).where(F.col("n") > 1)
    return known.join(groups, ["t1", "t2", "salt"]).where(F.col("id") > F.col("first")).select("id", "t1", "t2")


def failing_ids(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The documents without their texts, and one stored id table for each filter A to E."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    tests = text_filters(F.col("_text"), F.col("_words"))
    rows = cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
                           F.col(key).alias("id"), whole.alias("_text")).withColumn("_words", word_list(F.col("_text")))
               .select("row", "id", F.xxhash64(F.lit(1), "_text").alias("t1"), F.xxhash64(F.lit(2), "_text").alias("t2"),
                       *[c.alias(f"fails_{f}") for f, c in tests.items()]))
    tables = {f: cut(rows.where(f"fails_{f}").select("id", "t1", "t2").distinct()) for f in tests}
    tables["E"] = cut(later_copies(rows).distinct())
    return rows.select("row", "id", "t1", "t2"), tables


def relations(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``rows`` (with id, t1, t2) and ``cell``: bit i is set for rows in the i-th id table."""
    cells = rows.withColumn("cell", F.lit(0))
    for i, ids in enumerate(tables.values()):
        ids = ids.select(F.col("id").alias("f_id"), F.col("t1").alias("f1"), F.col("t2").alias("f2"))
        same = F.col("id").eqNullSafe(F.col("f_id")) & (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2"))
        fails = cells.join(ids, same, "left_semi").withColumn("cell", F.col("cell") + F.lit(1 << i))
        cells = cut(fails.union(cells.join(ids, same, "left_anti")))
    return cells


def order_counts(cells: DataFrame, names: list[str]) -> DataFrame:
    """The audit of all orders from (part, cell, n, good, toxic), where ``n`` documents
    lie in a cell."""
    k = len(names)
    sets = F.array(*[F.struct(F.lit(s).alias("before"), F.lit(i).alias("filter"), F.lit(1 << i).alias("bit"),
                              F.lit(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())).alias("orders"))
                     for i in range(k) for s in range(1 << k) if not s >> i & 1])
    at = cells.select("*", F.explode(sets).alias("s")).select("*", "s.*")
    fails = F.col("cell").bitwiseAND(F.col("bit")) != 0
    gone = F.col("cell").bitwiseAND(F.col("before")) != 0
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0))
    steps = at.groupBy("part", "before", "filter", "orders").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"), total("n", F.col("cell") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"), total("toxic", fails & ~gone).alias("toxic_lost"))
    steps = steps.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter")))
    # k! * k rows, whatever the data.
    orders = cells.sparkSession.createDataFrame(
        [("".join(names[i] for i in p), n + 1, sum(1 << i for i in p[:n]), p[n])
         for p in permutations(range(k)) for n in range(k)], "filter_order string, step int, before int, filter int")
    return steps.join(F.broadcast(orders), ["before", "filter"]).select(
        "part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, filter_order, step, counts): every order of the filters A to E over ``docs``."""
    # An id has at most one row here; ids without label stay out of the join, null ids too.
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows, tables = failing_ids(docs.select(key, text, part), key, text)
    base = rows.select("id", "t1", "t2", F.coalesce(F.col("row")[part].cast("string"), F.lit("")).alias("part")) \
        .groupBy("id", "t1", "t2", "part").agg(F.count(F.lit(1)).alias("n"))
    named = base.where(F.col("id").isNotNull()).join(marks, F.col("id") == F.col("l_id"), "left").select(
        *base.columns, F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    base = named.union(base.where(F.col("id").isNull()).select("*", F.lit(0), F.lit(0)))
    cells = relations(base, tables).groupBy("part", "cell").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return order_counts(cells, list(tables))
