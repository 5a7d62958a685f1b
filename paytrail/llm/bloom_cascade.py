"""Exact membership by a cascade of Bloom filters, and URL rules on top of it.

Level 1 encodes the listed keys; level 2 the unlisted keys of the universe that
pass level 1; level 3 the listed keys that pass level 2; and so on until a level
lets nothing wrong through.  A key's answer is the parity of the first level that
rejects it, exact for every key of the universe, with no join at query time.

Keys are dealt by hash into shards with a cascade each, so that one cascade holds
at most ``KEYS_PER_SHARD`` listed keys on average and the filters broadcast in one
pass stay under ``PASS_BYTES``; more shards are applied in further passes over
their own keys.

Defined results.  Null key: not a member.  Repeated keys: one key.  No listed key:
nothing is a member.  Empty universe: an empty cascade.  Keys outside the universe
may be wrong, as with any Bloom filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import cut

KEYS_PER_SHARD = 4_000_000
PASS_BYTES = 64 << 20
MAX_LEVELS = 64


@dataclass
class Level:
    bits: int
    probes: int
    words: np.ndarray  # uint64


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key).bitwiseOR(F.lit(1))


def _slots(h1: np.ndarray, h2: np.ndarray, level: Level, i: int, salt: int) -> np.ndarray:
    a, b = h1.astype(np.uint64), h2.astype(np.uint64)
    mixed = (a ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(31))) + np.uint64(i) * b) % np.uint64(level.bits)


def _passes(h1: np.ndarray, h2: np.ndarray, level: Level, salt: int) -> np.ndarray:
    ok = np.ones(len(h1), dtype=bool)
    for i in range(level.probes):
        s = _slots(h1, h2, level, i, salt)
        ok &= (level.words[(s >> np.uint64(6)).astype(np.int64)] >> (s & np.uint64(63))) & np.uint64(1) == 1
    return ok


def _depth(h1: np.ndarray, h2: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Number of leading levels that a key passes."""
    depth, alive = np.zeros(len(h1), dtype=np.int64), np.arange(len(h1))
    for salt, level in enumerate(levels, 1):
        alive = alive[_passes(h1[alive], h2[alive], level, salt)]
        depth[alive] += 1
    return depth


class Cascade:
    """Shards of levels; ``member`` tells the listed keys of the universe."""

    def __init__(self, shards: list[list[Level]]):
        self.shards = shards

    def nbytes(self, shard: int) -> int:
        return sum(level.words.nbytes for level in self.shards[shard])

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade:
        """Encode ``listed`` exactly over ``universe`` (listed keys are added to it)."""
        n = max(1, -(-listed.where(F.col(key).isNotNull()).count() // KEYS_PER_SHARD))
        both = listed.select(F.col(key).cast("string").alias("key"), F.lit(1).alias("on")).union(
            universe.select(F.col(key).cast("string"), F.lit(0)))
        h1, h2 = _hashes(F.col("key"))
        keys = cut(both.where("key is not null").groupBy("key").agg(F.max("on").alias("on"))
                   .select("on", h1.alias("h1"), h2.alias("h2"))
                   .withColumn("shard", F.pmod(F.shiftright("h1", 32), F.lit(n)).cast("int")))
        sizes = {(r["shard"], r["on"]): r["count"] for r in keys.groupBy("shard", "on").count().collect()}
        shards: list[list[Level]] = [[] for _ in range(n)]
        rows, turn = keys, 1
        left = {s: sizes.get((s, 1), 0) for s in range(n)}
        while any(left.values()):
            if turn > MAX_LEVELS:
                raise RuntimeError("two keys share both hashes")
            plan = {}
            for s, c in left.items():
                if c:
                    # Level 1 lets about listed / (2 * unlisted) of the others through, later levels half.
                    rate = 0.5 if turn > 1 else min(0.5, max(1e-6, 0.5 * c / max(1, sizes.get((s, 0), 0))))
                    bits = max(64, int(np.ceil(-c * np.log(rate) / np.log(2) ** 2 / 64)) * 64)
                    plan[s] = Level(bits, max(1, round(-np.log2(rate))), np.zeros(bits // 64, dtype=np.uint64))
            _fill(rows.where(F.col("on") == turn % 2), plan, turn)
            for s, level in plan.items():
                shards[s].append(level)
            # Keys of the other side that pass all levels so far go into the next one.
            spark, salt = rows.sparkSession, turn
            sent = spark.sparkContext.broadcast(plan)

            def survive(batches: Iterator[pd.DataFrame], sent=sent, salt=salt) -> Iterator[pd.DataFrame]:
                for b in batches:
                    ok = np.zeros(len(b), dtype=bool)
                    for s, level in sent.value.items():
                        at = np.flatnonzero(b["shard"].to_numpy() == s)
                        ok[at] = _passes(b["h1"].to_numpy()[at], b["h2"].to_numpy()[at], level, salt)
                    yield b[ok]

            wrong = rows.where(F.col("on") != turn % 2).mapInPandas(survive, rows.schema)
            rows = cut(wrong.union(rows.where(F.col("on") == turn % 2)))
            turn += 1
            left = {s: 0 for s in range(n)} | {
                r["shard"]: r["count"] for r in rows.where(F.col("on") == turn % 2).groupBy("shard").count().collect()}
        return Cascade(shards)

    def member(self, df: DataFrame, keys: str, out: str) -> DataFrame:
        """``df`` plus ``out``, an array of booleans: which of the array ``keys`` are listed?"""
        n, groups = len(self.shards), _passes_of({s: self.nbytes(s) for s in range(len(self.shards))})
        one, two = (lambda k: _hashes(k)[0]), (lambda k: _hashes(k)[1])
        df = df.withColumn(out, F.transform(keys, lambda _: F.lit(False)))
        for group in groups:
            sent = df.sparkSession.sparkContext.broadcast({s: self.shards[s] for s in group})

            listed = _listed(sent, n)
            hit = listed(F.transform(keys, one), F.transform(keys, two))
            known = F.transform(keys, lambda k: k.isNotNull())
            df = df.withColumn("_hit", hit).withColumn(out, F.zip_with(
                out, F.zip_with("_hit", known, lambda h, k: h & k), lambda x, y: x | y)).drop("_hit")
            if len(groups) > 1:
                df = cut(df)
        return df


def _passes_of(sizes: dict[int, int]) -> list[list[int]]:
    """Shards in groups of at most ``PASS_BYTES`` of filters."""
    groups: list[list[int]] = [[]]
    size = 0
    for s, b in sizes.items():
        if groups[-1] and size + b > PASS_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(s)
        size += b
    return groups


def _listed(sent, n: int):
    """Pandas UDF: which keys of an array, given by their hashes, are listed."""

    @F.pandas_udf("array<boolean>")
    def listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        lens = np.array([0 if x is None else len(x) for x in h1], dtype=np.int64)
        if not lens.sum():
            return pd.Series([np.zeros(0, dtype=bool)] * len(h1))
        a, b = (np.concatenate([x for x in h if x is not None and len(x)]).astype(np.int64) for h in (h1, h2))
        shard, hit = np.mod(a >> 32, n), np.zeros(len(a), dtype=bool)
        for s, levels in sent.value.items():
            at = np.flatnonzero(shard == s)
            hit[at] = _depth(a[at], b[at], levels) % 2 == 1
        return pd.Series(np.split(hit, np.cumsum(lens)[:-1]))

    return listed


def _fill(rows: DataFrame, plan: dict[int, Level], salt: int) -> None:
    """Set the bits of the planned levels; words are or-ed per task and again
    across tasks, so at most one row a word and task moves."""
    sent = rows.sparkSession.sparkContext.broadcast({s: (p.bits, p.probes) for s, p in plan.items()})

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s, (bits, probes) in sent.value.items():
                at = b["shard"].to_numpy() == s
                h1, h2 = b["h1"].to_numpy()[at], b["h2"].to_numpy()[at]
                level = Level(bits, probes, np.empty(0, np.uint64))
                for i in range(probes):
                    slot = np.unique(_slots(h1, h2, level, i, salt))
                    yield pd.DataFrame({"shard": s, "word": (slot >> np.uint64(6)).astype(np.int64),
                                        "bit": (np.uint64(1) << (slot & np.uint64(63))).astype(np.int64)})

    filled = rows.mapInPandas(words, "shard int, word long, bit long").groupBy("shard", "word").agg(
        F.bit_or("bit").alias("bits"))
    # One job for the shards of one pass: at most bits / 64 words a level, sized from the shard's listed keys.
    for group in _passes_of({s: p.words.nbytes for s, p in plan.items()}):
        got = filled.where(F.col("shard").isin(group)).toArrow()
        at, word = got["shard"].to_numpy(), got["word"].to_numpy()
        bits = got["bits"].to_numpy().view(np.uint64)
        for s in group:
            plan[s].words[word[at == s]] = bits[at == s]


# ---- URL rules ----

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(u, _URL, 1), UPPER, LOWER)
    return host, F.regexp_extract(u, _URL, 2)


def shapes(rules: DataFrame, rule: str) -> list[tuple[int, int]]:
    """The pairs (labels of the host, length of the path) that rules have."""
    slash = F.instr(rule, "/")
    host = F.when(slash == 0, F.col(rule)).otherwise(F.substring(F.col(rule), F.lit(1), slash - 1))
    length = F.when(slash == 0, 0).otherwise(F.length(rule) - slash + 1)
    found = rules.where(F.col(rule).isNotNull()).select(F.size(F.split(host, r"\.")).alias("labels"), length.alias("length"))
    return sorted((r.labels, r.length) for r in found.distinct().collect())


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The host suffixes at label borders joined with the path prefixes, of the given
    shapes: every rule string that could fit the url."""
    labels = F.split(host, r"\.")
    known = F.array(*[F.struct(F.lit(d).alias("labels"), F.lit(n).alias("length")) for d, n in shapes or [(1, 0)]])
    fitting = F.filter(known, lambda s: (s["labels"] <= F.size(labels)) & (s["length"] <= F.length(path)))
    return F.array_distinct(F.transform(fitting, lambda s: F.concat(
        F.array_join(F.slice(labels, -s["labels"], s["labels"]), "."), F.substring(path, F.lit(1), s["length"]))))


def _fitting(asked: Column, verdict: str) -> Column:
    return F.transform(asked, lambda x: F.struct(
        F.length(x["k"]).alias("n"), F.lit(verdict).alias("verdict"), x["k"].alias("rule")))


def hosts_with(pages: DataFrame, words: list[str], url: str = "url", least: int = 2) -> DataFrame:
    """(key) the hosts of ``pages`` with a label that joins ``least`` words by
    hyphens, one of them in ``words``."""
    host, _ = host_path(F.col(url))
    parts = F.transform(F.split("key", r"\."), lambda x: F.split(x, "-"))
    listed = F.array(*[F.lit(w) for w in words])
    return pages.select(host.alias("key")).distinct().where(F.exists(
        parts, lambda x: (F.size(x) >= least) & F.arrays_overlap(x, listed)))


def judge(pages: DataFrame, rules: DataFrame, listed_hosts: DataFrame | None = None, url: str = "url",
          default: str = "allow") -> DataFrame:
    """``pages`` plus host, path, rule, verdict by the longest fitting rule.

    ``rules``: rows (rule = host followed by path, verdict).  The rules of each
    verdict are the listed keys of one cascade; its universe are the candidate
    strings of all pages, so each page asks the filters about its own candidates, of the
    shapes that rules have only: a host of very many labels asks no more than others.
    No rule fits: "block" for a host (or its parent) among ``listed_hosts``, which
    are the keys of one more cascade over all hosts, else ``default``.  A rule listed with two verdicts counts with the
    alphabetically last one.  Columns of ``pages`` with one of the four names are
    replaced.
    """
    host, path = host_path(F.col(url))
    rows = pages.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("_keys", candidates(F.col("host"), F.col("path"), shapes(rules, "rule")))
    universe = cut(rows.select(F.explode(F.array_distinct("_keys")).alias("key")).distinct())
    best = [F.struct(F.lit(-1).alias("n"), F.lit(default).alias("verdict"), F.lit(None).cast("string").alias("rule"))]
    for i, v in enumerate(sorted(r[0] for r in rules.where("verdict is not null").select("verdict").distinct().collect())):
        listed = rules.where((F.col("verdict") == v) & F.col("rule").isNotNull()).select(F.col("rule").alias("key"))
        rows = Cascade.build(listed, universe).member(rows, "_keys", f"_in{i}")
        asked = F.filter(F.arrays_zip(F.col("_keys").alias("k"), F.col(f"_in{i}").alias("yes")), lambda x: x["yes"])
        best.append(F.array_max(_fitting(asked, v)))
    top = F.greatest(*best) if len(best) > 1 else best[0]
    if listed_hosts is not None:
        rows = rows.withColumn("_hosts", candidates(F.col("host"), F.lit(""), shapes(listed_hosts, "key")))
        hosts = cut(rows.select(F.explode("_hosts").alias("key")).distinct())
        rows = Cascade.build(listed_hosts, hosts).member(rows, "_hosts", "_listed")
        found = F.struct(F.lit(0).alias("n"), F.lit("block").alias("verdict"), F.lit(None).cast("string").alias("rule"))
        top = F.greatest(top, F.when(F.exists("_listed", lambda x: x), found))
    rows = rows.withColumn("_top", top).withColumn("rule", F.col("_top.rule")).withColumn("verdict", F.col("_top.verdict"))
    return rows.drop("_top", "_keys", "_hosts", "_listed", *[c for c in rows.columns if c.startswith("_in")])
