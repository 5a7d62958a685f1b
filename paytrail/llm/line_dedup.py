"""Line dedup across documents (native operations only).

Every text is split at line feeds and exploded; the key of a line is the line without
white space at its ends and with A-Z lower-cased.  Keys of ``MIN_CHARS`` code points
or more are hashed (128 bits) and their distinct documents counted.  A key found in
``MIN_DOCS`` documents loses its lines everywhere but in the largest document that
holds it; the other lines are put together again by position.

The exploded lines are shuffled once, on (key, salt of the document).  Distinct
documents are counted there; as all rows of a document share a salt, the counts of the
salts of a key add up.  Only these counts meet per key, at most ``SALTS`` of them, and
the verdict goes back to each (key, salt): no task holds a common line.

Defined results.  Null or empty text: one empty line, which stays.  Rows of one id are
one document, and each row gets its own result.  A row without id is a document of its
own for each different text, smaller than all ids.  Repeated lines of a document go or
stay together.  Empty table: empty result.  ``n_lines`` and ``n_dropped`` replace
columns of that name; all other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import cut, packed, salted, total_by_salt, unpacked

MIN_CHARS = 40
MIN_DOCS = 5
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(WHITE))
    # lower() has a fast path for ASCII text, where it does the same.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, LOWER))


def long_lines(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text_hash, pos, h1, h2) of every line with a key of ``min_chars`` or more, from (id, text_hash, text)."""
    lines = rows.select("id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")) \
        .where(F.char_length(F.btrim("line", F.lit(WHITE))) >= min_chars).withColumn("key", line_key(F.col("line")))
    return lines.select("id", "text_hash", "pos", F.xxhash64(F.lit(1), "key").alias("h1"),
                        F.xxhash64(F.lit(2), "key").alias("h2"))


def dropped_lines(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, text_hash, gone): the positions that each document loses."""
    # A document is an id, or the text where there is no id.
    nameless = F.when(F.col("id").isNull(), F.col("text_hash"))
    lines = long_lines(rows, min_chars).withColumn("nameless", nameless) \
        .withColumn("who", F.coalesce(F.xxhash64(F.lit(3), "id", "nameless"), F.lit(0)))
    lines = cut(salted(lines, ["h1", "h2"], "who").drop("who"))
    place = ["h1", "h2", "salt"]
    counts = lines.groupBy(*place, "id", "nameless").agg(F.lit(1).alias("one")).groupBy(*place).agg(
        F.count(F.lit(1)).alias("docs"), F.max("id").alias("last"), F.max("nameless").alias("last_nameless"))
    common = total_by_salt(counts, ["h1", "h2"], {"docs": F.sum, "last": F.max, "last_nameless": F.max}) \
        .where(F.col("docs") >= min_docs)
    stays = F.when(F.col("id").isNotNull(), F.col("id") == F.col("last")).otherwise(
        F.col("last").isNull() & (F.col("nameless") == F.col("last_nameless")))
    lost = lines.join(common, place).where(~stays)
    return lost.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone"))


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text",
           min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, and ``n_lines`` (before) and ``n_dropped``."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The text travels once, inside the row.
    whole = F.coalesce(F.col("row")[text].cast("string"), F.lit(""))
    rows = packed(docs.select(*[F.col(f"`{c}`") for c in kept])).withColumn("id", F.col("row")[key]).withColumn("text_hash", F.xxhash64(whole))
    lost = dropped_lines(rows.select("id", "text_hash", whole.alias("text")), min_chars, min_docs).select(
        F.col("id").alias("lost_id"), F.col("text_hash").alias("lost_hash"), "gone")
    both = rows.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("text_hash") == F.col("lost_hash")), "left") \
        .withColumn("text", whole).withColumn("lines", F.split("text", "\n", -1))
    # array_except is linear in the number of lines, however many go.
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    joined = F.when(F.col("gone").isNull(), F.col("text")).when(F.size("gone") == F.size("lines"), F.lit("")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return both.select(*[joined.alias(c) if c == text else unpacked(both, [c])[0] for c in kept],
                       F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
