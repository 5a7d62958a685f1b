"""Benchmark decontamination by template canonicalisation (native operations only).

Texts become token arrays in which numbers, names (capitalised words, at every place) and
units after a number are typed placeholders; all other words are lower-cased.  Windows of
``WIDTH`` canonical tokens are hash-joined between documents and benchmark items.  For each
alignment of an item with a document the values behind the placeholders are compared: one
benchmark value must always meet the same document value, which holds for a copy and for a
question with other names and numbers, but not for chance meetings of templates (two
benchmark values may meet one document value).  Windows with a benchmark value that meets
several are no evidence; the other windows of the alignment are.  A window with fewer than
half literal words tells little as a template: it is joined by its very values, so it
counts in a verbatim copy only.  An item leaks into a document if such windows cover at
least ``COVER`` of its tokens.

Items of one template (the same canonical tokens and the same places of equal values) are
one class, joined once and reported under its smallest id; ``n_items`` tells how many.  Items
with windows that need their values form classes with equal values only.

Defined results.  Null or empty text, on either side: no match.  Items shorter than a window
match as a whole; those of fewer than ``MIN_TOKENS`` tokens match only a document that has no
other tokens.  Repeated document rows: one result row per (id, text, class), so different
texts under one id, or without id, each have their own.  Empty tables: empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.operators.joins import materialize

WIDTH = 8
MIN_TOKENS = 4
COVER = 0.5
# Unit words recognised after a number.
UNITS = ("mm cm m km inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams ton tons tonne tonnes oz lb "
         "lbs ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day "
         "days week weeks month months year years usd eur gbp dollar dollars euro euros pound pounds cent cents percent "
         "degree degrees kph mph").split()
# Placeholders: digits, as every number of a text becomes NUMBER.
NUMBER, NAME, UNIT = "0", "1", "2"
_SEP = "\x01"
Of = Callable[[Column], Column]


def _tokens(text: Column) -> Column:
    """Runs of letters and digits; no separators inside a number, and a number apart from its unit."""
    joined = F.regexp_replace(text, r"[.,](?<=\d[.,])(?=\d)", "")
    apart = F.regexp_replace(joined, r"(\d)(?=\p{L})", "$1 ")
    return F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+", -1), "")


def _marked(tokens: Column, number: Of, name: Of, unit: Of, word: Of) -> Column:
    """Each token as its placeholder, or as ``word`` of it.  Tokens hold letters and digits alone, so
    plain comparisons tell their first character: digits, capitals, small letters, all others."""
    def one(t: Column, i: Column) -> Column:
        # The token before decides for most tokens already.
        is_unit = F.coalesce(F.get(tokens, i - 1) < ":", F.lit(False)) & F.lower(t).isin(*UNITS)
        first = F.substring(t, 1, 1)
        return F.when(t < ":", number(t)).when(t < "[", name(t)).when(
            (t >= "{") & (F.lower(first) != first), name(t)).when(is_unit, unit(t)).otherwise(word(t))
    return F.transform(tokens, one)


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_t")).where("_t is not null") \
        .select("_key", F.xxhash64("_t").alias("_text"), _tokens(F.col("_t")).alias("tokens"))


def _hashes(tokens: Column) -> Column:
    """The hash of each canonical token."""
    mark = [lambda _, m=m: F.xxhash64(F.lit(m)) for m in (NUMBER, NAME, UNIT)]
    return _marked(tokens, *mark, lambda t: F.xxhash64(F.lower(t)))


def _slots(tokens: Column) -> Column:
    """The lower-cased value at each placeholder, '' at a literal word."""
    return _marked(tokens, F.lower, F.lower, F.lower, lambda t: F.lit(""))


def templates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _text, n, h, v, slots): hashes of the canonical tokens, hashes of the
    values, and the value at each placeholder."""
    t = F.col("tokens")
    return _rows(df, key, text).select("_key", "_text", F.size(t).alias("n"), _hashes(t).alias("h"),
                                       F.transform(t, lambda x: F.xxhash64(F.lower(x))).alias("v"), _slots(t).alias("slots"))


def _weak(slots: Column, at: Column, width: Column) -> Column:
    """Does the window at ``at`` have fewer than half literal words?"""
    return F.size(F.array_remove(F.slice(slots, at, width), "")) * 2 > width


def windows(rows: DataFrame, kinds: list[tuple[int, str]]) -> DataFrame:
    """(_key, _text, n, at, hash): windows of token hashes, for each of ``kinds`` of its width
    over the column (``h`` or ``v``) that it names.  The kind is part of the hash; ``at``
    counts through the kinds one after the other (see :func:`place`)."""
    def of(width: int, over: str) -> Column:
        starts = F.when(F.size(over) >= width, F.sequence(F.lit(1), F.size(over) - (width - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.lit(f"{over}{width}"), F.slice(over, i, width)))
    made = of(*kinds[0]) if len(kinds) == 1 else F.concat(*[of(*k) for k in kinds])
    return rows.select("_key", "_text", "n", F.posexplode(made).alias("at", "hash"))


def place(kinds: list[tuple[int, str]], kind: tuple[int, str], n: Column, at: Column) -> Column:
    """The first token (from 1) of the window that :func:`windows` counts as ``at``, if it is of ``kind``."""
    before = [F.greatest(n - (width - 1), F.lit(0)) for width, _ in kinds[:kinds.index(kind)]]
    return at + 1 - sum(before, F.lit(0))


def item_classes(items: DataFrame, item: str, item_text: str, width: int) -> DataFrame:
    """One row per class of items: templates with ``pattern`` (place of the first equal
    value), ``_key`` (smallest id, n_items) and the window width."""
    unique = items.where(F.col(item_text).isNotNull()).groupBy(F.col(item_text).alias("_t")).agg(
        F.min(item).alias("_i"), F.countDistinct(item).alias("n_items"))
    rows = templates(unique.withColumn("_s", F.struct("_i", "n_items")), "_s", "_t").where("n > 0") \
        .withColumn("width", F.least("n", F.lit(width))).withColumn("pattern", F.transform("slots", lambda x: F.when(
            x == "", "").otherwise(F.array_position("slots", x).cast("string"))))
    bound = F.exists(F.sequence(F.lit(1), F.col("n") - F.col("width") + 1), lambda i: _weak(F.col("slots"), i, F.col("width")))
    return rows.withColumn("same", F.when(bound, F.col("slots")).otherwise(F.col("pattern"))) \
        .groupBy("h", "same", "n", "width").agg(
            F.struct(F.min("_key._i").alias("_i"), F.sum("_key.n_items").alias("n_items")).alias("_key"), F.min("_text").alias("_text"),
            *[F.min(c).alias(c) for c in ("v", "slots", "pattern")])


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item: str = "item_id", item_text: str = "text", width: int = WIDTH, cover: float = COVER) -> DataFrame:
    """(key, item, n_items, n_windows, n_slots, coverage) of each leaked pair."""
    bench = materialize(item_classes(items, item, item_text, width), "classes")
    widths = sorted(r[0] for r in bench.select("width").distinct().collect())  # at most WIDTH values
    if not widths:
        return docs.select(F.col(key)).where("false").select(
            key, F.lit(None).cast(dict(items.dtypes)[item]).alias(item), F.lit(0).cast("long").alias("n_items"),
            F.lit(0).cast("long").alias("n_windows"), F.lit(0).alias("n_slots"), F.lit(0.0).alias("coverage"))
    # The windows of the classes are stored, so that their bytes tell Spark how to join them.
    named = bench.withColumn("_key", F.struct("_key", "width", "pattern", "slots"))
    made = []
    for width, over in [(w, over) for w in widths for over in "hv"]:
        own = windows(named.where(F.col("width") == width), [(width, over)]).withColumn("ipos", F.col("at") + 1)
        made.append(own.where(_weak(F.col("_key.slots"), F.col("ipos"), F.lit(width)) == F.lit(over == "v")).select(
            F.col("hash").alias("i_hash"), F.col("_key._key").alias("item"), F.col("n").alias("n_tokens"),
            F.lit(width).alias("width"), F.lit(over).alias("over"), "ipos",
            F.array_join(F.slice("_key.pattern", F.col("ipos"), F.lit(width)), _SEP).alias("islots")))
    mine = materialize(reduce(DataFrame.unionByName, made), "windows")
    # Texts are hashed by their values only for widths at which some item needs that.
    kinds = [tuple(r) for r in mine.select("width", "over").distinct().orderBy("width", "over").collect()]
    rows = _rows(docs, key, text).select("_key", "_text", F.size("tokens").alias("n"), _hashes(F.col("tokens")).alias("h"), *[
        F.transform("tokens", lambda x: F.xxhash64(F.lower(x))).alias("v") for _ in range(any(k == "v" for _, k in kinds))])
    pos = F.coalesce(*[F.when((F.col("width") == k[0]) & (F.col("over") == k[1]), place(kinds, k, F.col("n"), F.col("at")))
                       for k in kinds])
    met = materialize(windows(rows, kinds).join(
        mine, (F.col("hash") == F.col("i_hash")) & ((F.col("n_tokens") >= MIN_TOKENS) | (F.col("n") == F.col("n_tokens")))).select(
        F.col("_key").alias("doc"), "_text", "item", "n_tokens", "width", "ipos", pos.alias("pos"), "islots"), "met")
    # Values are taken from the texts with a hit alone.  Hits grow with the documents: never broadcast.
    hit = met.select(F.col("doc").alias("h_doc"), F.col("_text").alias("h_text")).distinct()
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_t")).where("_t is not null")
    values = texts.join(hit.hint("merge"), F.col("_key").eqNullSafe(F.col("h_doc")) & (F.xxhash64("_t") == F.col("h_text")), "left_semi").distinct()
    values = _rows(values, "_key", "_t").select(F.col("_key").alias("h_doc"), F.col("_text").alias("h_text"), _slots(F.col("tokens")).alias("all"))
    hits = met.join(values, F.col("doc").eqNullSafe(F.col("h_doc")) & (F.col("_text") == F.col("h_text"))).select(
        "doc", "_text", "item", "n_tokens", "width", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"), "islots",
        F.array_join(F.slice("all", F.col("pos"), F.col("width")), _SEP).alias("dslots"))
    pairs = F.filter(F.zip_with(F.split("islots", _SEP, -1), F.split("dslots", _SEP, -1),
                                lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["a"] != "")
    alignment = ["doc", "_text", "item", "n_tokens", "width", "shift"]
    lined = hits.withColumn("pairs", pairs).groupBy(*alignment).agg(F.collect_set(F.struct("ipos", "pairs")).alias("at")) \
        .withColumn("slots", F.array_distinct(F.flatten("at.pairs")))
    # A benchmark value that is left twice among the different pairs meets several values.
    broken = F.array_distinct(F.transform(F.filter("slots", lambda p: F.size(F.filter(
        "slots", lambda o: o["a"] == p["a"])) > 1), lambda p: p["a"]))
    lined = lined.withColumn("broken", F.when(
        F.size(F.array_distinct("slots.a")) < F.size("slots"), broken).otherwise(F.array().cast("array<string>")))
    whole = F.filter("at", lambda w: ~F.arrays_overlap(w["pairs"]["a"], F.col("broken")))
    found = lined.withColumn("at", whole).select(
        "doc", "_text", "item", "n_tokens", "width", F.size(F.array_distinct(F.flatten("at.pairs"))).alias("n_slots"),
        F.explode("at.ipos").alias("ipos"))
    found = found.groupBy("doc", "_text", "item", "n_tokens", "width").agg(
        F.collect_set("ipos").alias("at"), F.count(F.lit(1)).alias("n_windows"), F.max("n_slots").alias("n_slots"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "at", lambda p: F.sequence(p, p + F.col("width") - 1)))))
    found = found.withColumn("coverage", covered / F.col("n_tokens")).where(F.col("coverage") >= cover)
    return found.select(F.col("doc").alias(key), F.col("item._i").alias(item), F.col("item.n_items").alias("n_items"),
                        "n_windows", "n_slots", "coverage")
