"""Language-model scoring by a probabilistic suffix tree over bytes.

The symbols are the UTF-8 bytes of a normalised text: A-Z lower-cased, words (runs
without ASCII white space) joined by one space, then one line feed as the end.  So
no symbol is ever unknown, and a text's probability is that of its token sequence.

Fitting.  Windows of ``DEPTH`` + 1 bytes of all training texts are counted (combined
per task, then per window).  A context of 1 to ``DEPTH`` bytes is a candidate if it
makes up at least ``P_MIN`` of all positions; it is kept if its next-symbol
distribution diverges from that of the context one byte shorter by ``DIVERGENCE``
nats over its positions.  A kept context's distribution is smoothed towards the
shorter one with as much weight as it has different next symbols.

Scoring.  Each symbol is predicted by the longest kept suffix of what precedes it.
The tree is bounded by DEPTH / P_MIN contexts whatever the corpus, and is broadcast.

Base score.  Word counts know no bound: texts are dealt to blocks of about
``BLOCK_CHARS`` characters, each block asks only for its own different words, counts
are summed per word and returned to the blocks.

Defined results.  Null text: empty, one end token.  Null id: as the empty text where
the held-out remainder is taken.  Repeated rows each count and get a score.  Very
long texts are scored in slices, never cut.  Empty table: empty result.  No training
row: uniform symbols, no known token.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import bucket, cut

DEPTH = 5
P_MIN = 2e-6
DIVERGENCE = 20.0
BLOCK_CHARS = 8_000_000
SLICE = 1 << 20
END = b"\n"
_PAD = b"\0" * (DEPTH - 1) + END


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def symbols(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def _codes(stream: np.ndarray, width: int) -> np.ndarray:
    """Windows of ``width`` bytes as numbers, the last byte lowest."""
    out, have = stream.astype(np.uint64), 1
    while have < width:
        step = min(have, width - have)
        out = (out[:len(out) - step] << np.uint64(8 * step)) | (out[step:] & np.uint64((1 << 8 * step) - 1))
        have += step
    return out


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    c, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(c, kind="stable")
    c, n = c[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    return c[first], np.add.reduceat(n, first)


def _count_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    codes, counts, held = [], [], 0

    def add(parts: list[bytes]) -> None:
        nonlocal held
        stream = np.frombuffer(b"".join(parts), dtype=np.uint8)
        for lo in range(0, len(stream) - DEPTH, SLICE):
            c = np.sort(_codes(stream[lo:lo + SLICE + DEPTH], DEPTH + 1))
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            codes.append(c[first])
            counts.append(np.diff(np.append(first, len(c))))
            held += len(first)

    def out() -> pd.DataFrame:
        # Windows that run over the border of two texts end in a pad byte after the end symbol: not counted.
        c, n = _merged(codes, counts)
        shifted = c.copy()
        ok = np.ones(len(c), dtype=bool)
        for _ in range(DEPTH - 1):
            ok &= ~(((shifted & np.uint64(255)) == 0) & (((shifted >> np.uint64(8)) & np.uint64(255)) == 10))
            shifted >>= np.uint64(8)
        last = c & np.uint64(255)
        ok &= last != 0
        ok &= ~((last == 10) & (((c >> np.uint64(8)) & np.uint64(255)) == 0))
        return pd.DataFrame({"code": c[ok].astype(np.int64), "n": n[ok].astype(np.int64)})

    for b in batches:
        parts, size = [], 0
        for t in b["text"]:
            s = _PAD + symbols(tokens(t))
            parts.append(s)
            size += len(s)
            if size >= SLICE:
                add(parts)
                parts, size = [], 0
        if parts:
            add(parts)
        if len(codes) > 1:
            c, n = _merged(codes, counts)
            codes, counts, held = [c], [n], len(c)
        if held > 6_000_000:  # bounded memory; the shuffle adds up what is sent early
            yield out()
            codes, counts, held = [], [], 0
    if codes:
        yield out()


@dataclass
class Table:
    """Hash table from 64-bit codes to floats with vectorised look-up."""
    codes: np.ndarray
    values: np.ndarray
    slots: np.ndarray | None = field(default=None, repr=False)

    def _slot(self, c: np.ndarray) -> np.ndarray:
        return ((c * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def build(self) -> Table:
        self.bits = max(4, int(math.ceil(math.log2(max(1, len(self.codes)) * 4))))
        size = 1 << self.bits
        self.key = np.full(size, np.uint64(2**64 - 1))
        self.slots = np.zeros(size, dtype=np.float32)
        rest = np.arange(len(self.codes))
        at = self._slot(self.codes)
        while len(rest):
            free = self.key[at] == np.uint64(2**64 - 1)
            _, first = np.unique(at, return_index=True)
            take = np.zeros(len(rest), dtype=bool)
            take[first] = True
            take &= free
            self.key[at[take]] = self.codes[rest[take]]
            self.slots[at[take]] = self.values[rest[take]]
            rest, at = rest[~take], (at[~take] + 1) & (size - 1)
        return self

    def get(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, found) of each code."""
        at = self._slot(c)
        key = self.key[at]
        value, found = self.slots[at], key == c
        todo = np.flatnonzero(~found & (key != np.uint64(2**64 - 1)))
        mask = len(self.key) - 1
        step = at[todo]
        while len(todo):
            step = (step + 1) & mask
            key = self.key[step]
            hit = key == c[todo]
            value[todo[hit]] = self.slots[step[hit]]
            found[todo[hit]] = True
            go = ~hit & (key != np.uint64(2**64 - 1))
            todo, step = todo[go], step[go]
        return value, found


@dataclass
class Tree:
    root: np.ndarray                     # log10 P of each byte without context
    seen: list[tuple[np.ndarray, np.ndarray]]     # by depth: (context, symbol) codes and log10 P
    back: list[tuple[np.ndarray, np.ndarray]]     # by depth: context codes and log10 weight of the shorter one
    tables: list | None = field(default=None, repr=False)

    def shorter(self, code: np.ndarray, depth: int) -> np.ndarray:
        """P of the codes' symbols after the longest kept context under ``depth`` bytes."""
        out = 10.0 ** self.root[code & 255]
        for d in range(1, depth):
            at, want = self.seen[d - 1][0], (code & ((1 << 8 * (d + 1)) - 1)).astype(np.uint64)
            if len(at):
                i = np.minimum(np.searchsorted(at, want), len(at) - 1)
                out = np.where(at[i] == want, 10.0 ** self.seen[d - 1][1][i].astype(float), out)
        return out

    def log10(self, stream: np.ndarray) -> np.ndarray:
        """log10 P of the bytes from position DEPTH of ``stream`` on."""
        if self.tables is None:
            self.tables = [(Table(*s).build(), Table(*b).build()) for s, b in zip(self.seen, self.back)]
        wide = _codes(stream, DEPTH + 1)
        out = np.zeros(len(wide), dtype=np.float32)
        todo = np.arange(len(wide))
        # From the longest context down: a symbol not seen there pays for the step to the shorter one.
        for depth in range(DEPTH, 0, -1):
            seen, back = self.tables[depth - 1]
            code = wide[todo] & np.uint64((1 << 8 * (depth + 1)) - 1)
            value, found = seen.get(code)
            out[todo[found]] += value[found]
            todo, code = todo[~found], code[~found]
            weight, kept = back.get(code >> np.uint64(8))
            out[todo[kept]] += weight[kept]
        out[todo] += self.root[(wide[todo] & np.uint64(255)).astype(np.int64)]
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each normalised text."""
        out = np.zeros(len(texts))
        group, size, start = [], 0, 0

        def flush(upto: int) -> None:
            stream = np.frombuffer(b"".join(_PAD + t for t in group), dtype=np.uint8)
            parts = [self.log10(stream[lo:lo + SLICE + DEPTH]) for lo in range(0, len(stream) - DEPTH, SLICE)]
            logs = np.concatenate(parts).astype(np.float64)
            ends = np.cumsum([len(t) + DEPTH for t in group])
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            begins = np.concatenate([[0], ends[:-1]])
            out[start:upto] = sums[ends - DEPTH] - sums[begins]

        for i, t in enumerate(texts):
            group.append(t)
            size += len(t)
            if size >= SLICE:
                flush(i + 1)
                group, size, start = [], 0, i + 1
        if group:
            flush(len(texts))
        return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", held: int = 2,
        p_min: float = P_MIN, divergence: float = DIVERGENCE) -> Tree:
    """Learn from the rows whose crc32(id as text) mod 7 is not ``held``."""
    rows = docs.where(bucket(key, 7) != held).select(F.col(text).cast("string").alias("text"))
    full = cut(rows.mapInPandas(_count_windows, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    total = full.agg(F.sum("n")).head()[0] or 0
    single = {int(r["code"]): int(r["n"]) for r in full.groupBy(F.col("code").bitwiseAND(255).alias("code"))
              .agg(F.sum("n").alias("n")).collect()}
    counts = np.array([single.get(s, 0) for s in range(256)], dtype=float)
    root = (counts + 1) / (total + 256)
    tree = Tree(np.log10(root), [], [])
    shorter = None
    for depth in range(1, DEPTH + 1):
        level = full.groupBy(F.col("code").bitwiseAND((1 << 8 * (depth + 1)) - 1).alias("code")).agg(F.sum("n").alias("n"))
        if depth < DEPTH:
            level = cut(level)
        context = F.shiftright("code", 8)
        totals = level.groupBy(context.alias("context")).agg(
            F.sum("n").alias("c"), F.count(F.lit(1)).alias("kinds")).where(F.col("c") >= max(1.0, p_min * total))
        rows = level.withColumn("context", context).join(totals, "context")
        if shorter is None:
            spark = docs.sparkSession
            shorter = spark.createDataFrame([(s, float(c) / max(1, total)) for s, c in single.items()] or [(0, 1.0)],
                                            "short long, q double")
        part = rows.withColumn("short", F.col("code").bitwiseAND((1 << 8 * depth) - 1)).join(shorter, "short") \
            .withColumn("p", F.col("n") / F.col("c"))
        part = cut(part.select("code", "context", "n", "c", "kinds", "p", "q"))
        kept = part.groupBy("context").agg(F.sum(F.col("n") * F.log(F.col("p") / F.col("q"))).alias("gain")) \
            .where(F.col("gain") >= divergence).select("context")
        # At most 1 / p_min contexts a depth, with at most 256 symbols each.
        got = part.join(kept, "context").select("code", "n", "c", "kinds").toArrow().sort_by("code")
        code, n, c, kinds = (got[x].to_numpy() for x in ("code", "n", "c", "kinds"))
        p = (n + kinds * tree.shorter(code, depth)) / (c + kinds)
        tree.seen.append((code.astype(np.uint64), np.log10(p).astype(np.float32)))
        contexts, first = np.unique(code >> 8, return_index=True)
        weight = np.log10(kinds[first] / (c[first] + kinds[first])).astype(np.float32)
        tree.back.append((contexts.astype(np.uint64), weight))
        shorter = part.select(F.col("code").alias("short"), F.col("p").alias("q"))
    return tree


def score(docs: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text", held: int = 2) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.length(text).cast("long"))).head()[0] or 0
    blocks = max(1, -(-size // BLOCK_CHARS))
    rows = docs.select(F.col(key).cast("string").alias("id"), (bucket(key, 7) == held).alias("held"),
                       F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", F.length("text")), F.lit(blocks)).cast("int"))
    dealt = rows.repartition(blocks, "block")

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        counts, other = Counter(), set()
        for t, h in zip(block["text"], block["held"]):
            if h:
                other.update(tokens(t))
                other.add(END)
            else:
                counts.update(tokens(t))
                counts[END] += 1
        other -= counts.keys()
        return pd.DataFrame({"block": int(block["block"].iloc[0]), "word": [*counts, *other],
                             "c": [*counts.values(), *[0] * len(other)]})

    words = dealt.groupBy("block").applyInPandas(ask, "block int, word binary, c long")
    by_word = Window.partitionBy("word")
    totals = words.select("block", "word", "c", F.sum("c").over(by_word).alias("total"),
                          (F.row_number().over(by_word.orderBy("block")) == 1).alias("lead"))
    sent = spark.sparkContext.broadcast(tree)

    def judge(block: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        known = dict(zip(words["word"].map(bytes), words["total"]))
        ids, out, texts = [], [], []
        for i, h, t in zip(block["id"], block["held"], block["text"]):
            found = tokens(t)
            texts.append(symbols(found))
            c = np.fromiter((known[w] for w in [*found, END]), dtype=np.int64, count=len(found) + 1)
            ids.append(i)
            out.append((bool(h), len(c), int((c > 0).sum()), float(np.log10(c + 1.0).sum()), 0))
        made = pd.DataFrame(out, columns=["held_out", "n_tokens", "n_known", "raw", "v"])
        made.insert(0, "id", ids)
        made["score"] = sent.value.scores(texts)
        made["n"] = 0
        made["kind"] = 0
        # One row for the block: its training tokens, and the known words that it stands for.
        lead = int((words["lead"] & (words["total"] > 0)).sum())
        made.loc[len(made)] = [None, False, 0, 0, 0.0, lead, 0.0, int(words["c"].sum()), 1]
        return made

    schema = ("id string, held_out boolean, n_tokens long, n_known long, raw double, v long, score double, "
              "n long, kind int")
    scored = cut(dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(judge, schema))
    n, v = scored.where("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).head()
    per_token = math.log10(n + v + 1)
    return scored.where("kind = 0").select(
        F.col("id").cast(dict(docs.dtypes)[key]).alias(key), "held_out", "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("raw") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), "score")
