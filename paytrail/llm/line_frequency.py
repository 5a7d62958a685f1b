"""Quality rules: base rules on a text, and line frequency across documents.

A line is normalised (lower case, runs of white space as one space, digits as 0)
and hashed; per host the distinct documents that hold it are counted.  Lines above
the limit of their host are boilerplate and are removed; a document that keeps too
little is depleted and rejected.

The limit of a host is ``MAX_SHARE`` of its distinct texts, but ``MIN_DOCS`` at least
and ``MAX_DOCS`` at most, so that it does not loosen without end in a large host.  Equal texts count as one document here, so that many copies of a clean
document do not make its lines boilerplate; removing copies is the work of the
near-duplicate operator.

Counts are combined map-side per (host, line, text) and hot lines are salted in
the join back, so neither a host nor a line needs one task.

Defined results.  Null text: no words, base_failed.  Null host: a host of its own.
Lines without a word are never counted or removed.  Repeated rows: each gets the
result; they count as one document.  Empty table: empty result.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import cut

MIN_DOCS = 20
MAX_DOCS = 1000
MAX_SHARE = 0.005
MIN_WORDS = 10
MIN_LEFT = 0.2
SALTS = 16
_WHITE = "\\x20\\x09-\\x0D"

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def base_metrics(text: str | None, window: int = 5) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at exactly the six white-space characters
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    rows = Counter(line for line in text.split("\n") if line.strip(" \t\v\f\r"))
    repeats = sum(rows.values()) - len(rows)
    if len(words) < window:
        return len(words), chars, symbols, repeats, 0
    windows = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(windows)
    covered = until = 0
    if len(counts) < len(windows):
        for i, w in enumerate(windows):
            if counts[w] > 1:
                covered += i + window - max(until, i)
                until = i + window
    return len(words), chars, symbols, repeats, covered


def _base(text: str) -> Column:
    names = [f.split()[0] for f in BASE.split(", ")]

    @F.pandas_udf(BASE)
    def metrics(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([base_metrics(t) for t in text], columns=names).astype("int64")

    return metrics(text)


def normalise(line: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), f"[{_WHITE}]+", " ")), r"\p{Nd}", "0")


def _rows(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), F.coalesce(F.col(host).cast("string"), F.lit("\0null")).alias("_host"),
                       F.col(text).cast("string").alias("_text")) \
        .withColumn("_id", F.xxhash64(F.lit(5), "_text")).withColumn("_id2", F.xxhash64(F.lit(6), "_text"))


def line_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(host, line, words) rows: distinct lines of each distinct text of a host.
    ``words`` counts the words that the line covers in the text."""
    texts = _rows(docs, key, text, host).where(F.col("_text").isNotNull())
    norm = F.transform(F.split("_text", "\n", -1), normalise)
    lines = F.filter(norm, lambda x: x != "")
    return texts.select("_host", "_id", "_id2", F.explode(F.transform(lines, lambda x: F.struct(
        F.xxhash64(F.lit(7), x).alias("line"), F.size(F.split(x, " ")).cast("long").alias("words")))).alias("l")) \
        .select("_host", "_id", "_id2", "l.line", "l.words")


def boilerplate(lines: DataFrame, texts: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line, n_docs) of the lines above the limit of their host; ``texts``
    has a row (host, text) for each document."""
    once = lines.groupBy("_host", "line", "_id", "_id2").agg(F.sum("words").alias("words"))
    counts = once.groupBy("_host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = texts.groupBy("_host", "_id", "_id2").agg(F.lit(1).alias("one")).groupBy("_host").agg(
        F.count(F.lit(1)).alias("n_texts"))
    return counts.join(hosts, "_host").where(
        F.col("n_docs") > F.least(F.col("n_texts") * max_share, F.lit(float(max_docs)))) \
        .select("_host", "line", "n_docs")


def removed_words(lines: DataFrame, bad: DataFrame) -> DataFrame:
    """(host, text, removed): words of boilerplate lines in each distinct text."""
    salted = bad.select("_host", "line").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = lines.withColumn("_salt", F.pmod("_id", F.lit(SALTS)).cast("int"))
    hit = rows.join(salted, ["_host", "line", "_salt"])
    # A text that occurs n times in a host has n equal sets of rows here.
    return hit.groupBy("_host", "_id", "_id2").agg(F.sum("words").alias("_removed_all"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
          min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS) -> DataFrame:
    """(key, base metrics, base_failed, removed_words, depleted, kept) of every row."""
    lines = line_counts(docs, key, text, host)
    texts = _rows(docs, key, text, host).where(F.col("_text").isNotNull())
    bad = cut(boilerplate(lines, texts, min_docs, max_share, max_docs))
    rows = _rows(docs, key, text, host).withColumn("b", _base("_text")).select("_key", "_host", "_id", "_id2", "b.*")
    gone = removed_words(lines, bad)
    copies = rows.groupBy("_host", "_id", "_id2").agg(F.count(F.lit(1)).alias("_copies"))
    gone = gone.join(copies, ["_host", "_id", "_id2"]).select(
        "_host", "_id", "_id2", (F.col("_removed_all") / F.col("_copies")).cast("long").alias("removed"))
    out = rows.join(gone, ["_host", "_id", "_id2"], "left")
    removed = F.coalesce("removed", F.lit(0))
    left = F.col("n_words") - removed
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (left < MIN_WORDS) | (left < MIN_LEFT * F.col("n_words"))
    return out.select(F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), removed.alias("removed_words"), depleted.alias("depleted"),
                      (~failed & ~depleted).alias("kept"))


def clean(docs: DataFrame, bad: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with the lines of ``bad`` cut out of ``text``.  The lines of a
    document are matched in an array, so no document is split over rows."""
    named = docs.withColumn("_host", F.coalesce(F.col(host).cast("string"), F.lit("\0null"))) \
        .withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select("_host", "_row")
    rows = named.withColumn("_rid", F.xxhash64("_host", F.col("_row")[text]))
    lines = rows.select("_host", "_rid", F.explode(F.split(F.col("_row")[text], "\n", -1)).alias("l")) \
        .select("_host", "_rid", F.xxhash64(F.lit(7), normalise(F.col("l"))).alias("line")).distinct()
    hits = lines.join(bad.select("_host", "line"), ["_host", "line"]).groupBy("_host", "_rid").agg(
        F.collect_set("line").alias("_bad"))
    out = rows.join(hits, ["_host", "_rid"], "left")
    kept = F.filter(F.split(F.col("_row")[text], "\n", -1), lambda x: F.col("_bad").isNull()
                    | ~F.array_contains("_bad", F.xxhash64(F.lit(7), normalise(x))))
    return out.select(*[F.array_join(kept, "\n").alias(c) if c == text else F.col("_row")[c].alias(c)
                        for c in docs.columns])
