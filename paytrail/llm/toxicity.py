"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

A term is the first ``STEM`` letters of a word, which inflected and compound forms share.

Fitting.  At most about ``MAX_EXAMPLES`` labelled texts (a documented bound; chosen
by hash of the text, equal texts once) become examples.  All terms of the examples
are the vocabulary, whatever their label; terms are held as 64-bit hashes.  Document
frequencies of the vocabulary are counted over the whole corpus.

Scoring.  A text is the TF-IDF vector of its vocabulary terms.  The examples are
kept in an inverted index whose postings are cut into blocks of ``BLOCK`` examples
with the largest weight of each term in the block.  Blocks are read in the order of
their upper bound, in rounds that double, until the bound falls under the K-th best
cosine, so the K neighbours are exact (weights are stored as single precision).  Terms
in more than ``DENSE`` of the examples have no postings but a row of a matrix: a batch of
texts is multiplied with it at once, and the bound of a block is then the largest of these
products in it and the bounds of its other terms.  Products serve to find the candidates;
the cosines of those within ``MARGIN`` of the K-th are summed again in double precision.  The
votes of the neighbours, weighted by cosine and drawn to the base rate by ``PRIOR``
votes, give the score; the neighbours are the evidence.  A text with words of which
none is known gets the base rate.

Inputs of a score are the text alone.  The index is bounded by the examples and is
broadcast.

Defined results.  Null and empty text, or a text without a word: the toxic rate of
such examples, 0 without any.  Rows without label, with null label or null doc_id:
not learned from.  Differing labels of one doc_id: toxic if any is.  Equal cosines:
the example that sorts first in the index.  No labelled row: every score 0.  Repeated
rows each get their score.  Other columns stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import bucket, cut

MAX_EXAMPLES = 20_000
BLOCK = 128
FOLD = 128
PARTS = 8             # the examples reach the driver in so many parts
STEM = 4
DENSE = 0.05
BATCH = 128           # texts multiplied with the matrix at once
MARGIN = 1e-4         # far above the error of a single-precision sum of cosines
K = 11
PRIOR = 1.0
CUTOFF = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_STEM = re.compile(rf"([^\W\d_]{{1,{STEM}}})[^\W\d_]*")


def terms(text: str | None) -> list[str]:
    return _STEM.findall(text.lower()) if text else []


def hashed(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode("utf-8", "surrogatepass"))


def spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges lo .. hi - 1, one range after the other."""
    size = hi - lo
    ends = np.cumsum(size)
    return np.repeat(lo - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """Numbers of the known terms of a text.  What a term gives is remembered, as
    most terms of a corpus are repeated."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.seen = hashes, {}  # sorted

    def __len__(self) -> int:
        return len(self.hashes)

    def __reduce__(self):
        return Vocabulary, (self.hashes,)

    def _learn(self, new: list[str]) -> None:
        # Unknown terms are forgotten now and then; what is not remembered is unknown.
        if len(self.seen) > len(self.hashes) + 50_000:
            self.seen = {t: i for t, i in self.seen.items() if i >= 0}
        h = np.array([hashed(t) for t in new], dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), dtype=bool)
        self.seen.update(zip(new, np.where(known, at, -1).tolist()))

    def known(self, text: str | None) -> list[int]:
        """The numbers of the known terms, in any order."""
        found = set(terms(text))
        new = found.difference(self.seen)
        if new:
            self._learn(list(new))
        return [i for t in found if (i := self.seen.get(t, -1)) >= 0]

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, occurrences) of the known terms, by number."""
        found = Counter(terms(text))
        new = [t for t in found if t not in self.seen]
        if new:
            self._learn(new)
        at = np.fromiter((self.seen.get(t, -1) for t in found), dtype=np.int64, count=len(found))
        n = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        order = np.argsort(at)[int((at < 0).sum()):]
        return at[order], n[order]


def smallest(x: np.ndarray) -> np.ndarray:
    """The same numbers (none negative) in as few bytes as hold them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


@dataclass
class Index:
    vocabulary: Vocabulary
    idf: np.ndarray
    ids: np.ndarray            # doc ids of the examples
    toxic: np.ndarray
    norm: np.ndarray           # lengths of their vectors
    example: np.ndarray        # postings by (term, example)
    times: np.ndarray          # how often the term occurs there
    size: np.ndarray           # per term: its postings
    base: float
    empty: float               # score of a text without terms

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("tables", "frequent", "tops")}

    @cached_property
    def frequent(self) -> np.ndarray:
        """Rows of the matrix: the terms in many examples."""
        return np.flatnonzero(self.size > DENSE * len(self.ids))

    @cached_property
    def tables(self) -> tuple[np.ndarray, ...]:
        """Not sent, made where it is used: the matrix (frequent terms by examples, whole
        blocks) and the row of each term in it (-1: none); of the other terms, examples and
        weights of the postings; per term its first entry (the postings of a term in a
        block); per entry block, largest weight and first posting."""
        term = np.repeat(np.arange(len(self.size), dtype=np.int32), self.size)
        weight = (1 + np.log(np.arange(1, int(self.times.max()) + 1))).astype(np.float32)[self.times - 1] if len(term) else \
            np.empty(0, np.float32)
        weight *= self.idf.astype(np.float32)[term]
        weight /= self.norm.astype(np.float32)[self.example]
        example = self.example.astype(np.int32)
        row = np.full(len(self.size), -1, np.int32)
        row[self.frequent] = np.arange(len(self.frequent))
        matrix = np.zeros((len(self.frequent), -(-len(self.ids) // BLOCK) * BLOCK), np.float32)
        common = row[term] >= 0
        matrix[row[term[common]], example[common]] = weight[common]
        common = ~common
        term, weight, example = term[common], weight[common], example[common]
        block = example // BLOCK
        new = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        top = np.maximum.reduceat(weight, new) if len(new) else weight
        return (matrix, row, example, weight, np.searchsorted(term[new], np.arange(len(self.size) + 1)), block[new],
                top, np.append(new, len(term)).astype(np.int32))

    @property
    def postings(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per term: examples and weights."""
        matrix, row, example, weight, entry_at, _, _, post_at = self.tables
        out = []
        for r, lo, hi in zip(row, entry_at[:-1], entry_at[1:]):
            part = np.flatnonzero(matrix[r]) if r >= 0 else slice(post_at[lo], post_at[hi])
            out.append((part, matrix[r][part]) if r >= 0 else (example[part], weight[part]))
        return out

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.vocabulary.count(text)

    def weights(self, vector: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at, n = vector
        w = (1 + np.log(n)) * self.idf[at]
        return at, w / math.sqrt(float(w @ w))

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Index positions and cosines of the ``k`` nearest examples with a cosine over 0."""
        return next(self.nearest_of([vector], k))

    def nearest_of(self, vectors: list, k: int = K) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """In the order of ``vectors``.  Like texts are multiplied together, those of one
        language above all, so that a batch needs part of the matrix only."""
        matrix, row, *_ = self.tables
        tops = self.tops
        weighed = [self.weights(v) for v in vectors]
        rows = [row[at] for at, _ in weighed]
        alike = [int(np.argmax(w[r >= 0] @ tops[r[r >= 0]])) if (r >= 0).any() else -1 for (_, w), r in zip(weighed, rows)]
        order = np.argsort(alike, kind="stable").tolist()
        found: list = [None] * len(vectors)
        for start in range(0, len(order), BATCH):
            now = order[start:start + BATCH]
            used = np.unique(np.concatenate([rows[i][rows[i] >= 0] for i in now]))
            place = np.zeros(len(matrix) + 1, np.int64)
            place[used] = np.arange(len(used))
            asked = np.zeros((len(now), len(used)), np.float32)
            for j, i in enumerate(now):
                here = rows[i] >= 0
                asked[j, place[rows[i][here]]] = weighed[i][1][here]
            products = asked @ matrix[used]
            best = products.reshape(len(now), -1, BLOCK).max(axis=2)
            for j, i in enumerate(now):
                found[i] = self._search(*weighed[i], products[j], best[j], k)
        yield from found

    @cached_property
    def tops(self) -> np.ndarray:
        """Largest weight of each frequent term in each block."""
        matrix = self.tables[0]
        return matrix.reshape(len(matrix), -1, BLOCK).max(axis=2)

    def _search(self, at: np.ndarray, w: np.ndarray, common: np.ndarray, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``common``: the sums over the frequent terms, in single precision; ``best``: the largest of each block."""
        matrix, row, example, weight, entry_at, entry_block, top, post_at = self.tables
        r = row[at]
        rare = r < 0
        lo, hi = entry_at[at[rare]], entry_at[at[rare] + 1]
        entry, q = spans(lo, hi), np.repeat(w[rare], hi - lo)
        block = entry_block[entry]
        blocks = len(common) // BLOCK
        bounds = best + np.bincount(block, q * top[entry], blocks)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        others = np.zeros(len(common))
        near_at, near, done, step = np.empty(0, dtype=np.int64), np.empty(0), 0, 16
        floor = 0.0  # the K-th best so far, less the margin
        while done < len(order):
            now = order[done:done + step]
            now = now[bounds[now] >= floor]
            if not len(now):
                break
            wanted = np.zeros(blocks, dtype=bool)
            wanted[now] = True
            part = np.flatnonzero(wanted[block])
            first, last = post_at[entry[part]], post_at[entry[part] + 1]
            post = spans(first, last)
            others += np.bincount(example[post], np.repeat(q[part], last - first) * weight[post], len(common))
            here = (now[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            found = others[here] + common[here]
            hit = found > max(floor, 0.0)
            near_at, near = np.concatenate([near_at, here[hit]]), np.concatenate([near, found[hit]])
            if len(near) > k:
                floor = max(floor, np.partition(near, len(near) - k)[len(near) - k] - MARGIN)
                near_at, near = near_at[near >= floor], near[near >= floor]
            done, step = done + step, step * 2
        exact = (others[near_at] + w[~rare] @ matrix[np.ix_(r[~rare], near_at)].astype(np.float64)).round(12)
        pick = np.lexsort((near_at, -exact))[:k]
        pick = pick[exact[pick] > 0]
        return near_at[pick], exact[pick]

    def scores(self, vectors: list) -> list[tuple[float, list[int]]]:
        known = [v for v in vectors if len(v[0])]
        found = self.nearest_of(known)
        out = []
        for v in vectors:
            if not len(v[0]):
                out.append((self.base, []))
                continue
            at, cosine = next(found)
            votes = float(cosine @ self.toxic[at]) + PRIOR * self.base
            out.append((votes / (float(cosine.sum()) + PRIOR), [int(x) for x in self.ids[at]]))
        return out


def folded(term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A vector folded to ``FOLD`` numbers by signed hashing of its terms."""
    mixed = (term.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sign = np.where((mixed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    return np.bincount((mixed >> np.uint64(32)).astype(np.int64) % FOLD, weight * sign, FOLD)


def laid_out(points: np.ndarray) -> np.ndarray:
    """An order of the examples in which like ones are neighbours: halved again and
    again along the main direction of their folded vectors."""
    parts = [np.arange(len(points))]
    while max(map(len, parts)) > BLOCK:
        halves = []
        for p in parts:
            if len(p) <= BLOCK:
                halves.append(p)
                continue
            x = points[p] - points[p].mean(axis=0)
            main = np.linalg.eigh(x.T @ x)[1][:, -1]
            turned = p[np.argsort((x @ main).round(6), kind="stable")]
            half = -(-len(p) // BLOCK) // 2 * BLOCK
            halves += [turned[:half], turned[half:]]
        parts = halves
    return np.concatenate(parts)


def build_index(parts: list[pa.Table], vocabulary: np.ndarray, idf: np.ndarray) -> Index:
    """Index of the examples in ``parts``: rows (id, toxic, norm, at, n, fold)."""
    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.empty(0, kind), *[p[name].to_numpy() for p in parts]]).astype(kind)

    def flat(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.empty(0, kind), *[pc.list_flatten(p[name]).to_numpy() for p in parts]]).astype(kind, copy=False)

    ids, toxic, norm = column("id", np.int64), column("toxic", np.float64), column("norm", np.float64)
    size = np.concatenate([np.empty(0, np.int64), *[pc.list_value_length(p["at"]).to_numpy() for p in parts]]).astype(np.int64)
    term, n = flat("at", np.int32), smallest(flat("n", np.int32))
    points = flat("fold", np.float32).reshape(-1, FOLD)[size > 0].astype(float)
    parts.clear()
    base = (float(toxic.sum()) + 0.5) / (len(ids) + 1) if len(ids) else 0.0
    bare = toxic[size == 0]
    rate = float(bare.mean()) if len(bare) else 0.0
    ids, toxic, norm, size = ids[size > 0], toxic[size > 0], norm[size > 0], size[size > 0]
    order = laid_out(points)
    place = np.empty(len(ids), dtype=np.int32)
    place[order] = np.arange(len(ids))
    example = np.repeat(smallest(place), size)
    # Sorted by (term, example) in ranges of the terms, which bounds the driver's memory.
    post_example, post_n, done = np.empty_like(example), np.empty_like(n), 0
    edges = np.linspace(0, len(vocabulary), PARTS + 1).astype(np.int64)
    for lo, hi in zip(edges[:-1], edges[1:]):
        pick = np.flatnonzero((term >= lo) & (term < hi))
        pick = pick[np.argsort(term[pick].astype(np.int64) * max(1, len(ids)) + example[pick])]
        post_example[done:done + len(pick)], post_n[done:done + len(pick)] = example[pick], n[pick]
        done += len(pick)
    return Index(Vocabulary(vocabulary), idf, ids[order], toxic[order], norm[order], post_example, post_n,
                 np.bincount(term, minlength=len(vocabulary)), base, rate)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_examples: int = MAX_EXAMPLES, held: int = 2) -> Index:
    """Learn from the labelled rows whose crc32(id as text) mod 4 is not ``held``."""
    spark = docs.sparkSession
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (bucket(key, 4) != held)) \
        .groupBy(F.col(key).alias("_k")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    named = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_k"), F.col(text).cast("string").alias("text"))
    named = named.withColumn("h", F.xxhash64(F.lit(17), "text")).withColumn("m", F.md5(F.encode("text", "UTF-8")))
    # Only hashes move for the choice of examples; the bounded choice is broadcast to read its texts.
    distinct = cut(named.select("_k", "h", "m").join(marks, "_k").groupBy("h", "m").agg(
        F.min("_k").alias("_k"), F.max("toxic").alias("toxic")))
    n = distinct.count()
    if n > max_examples:
        distinct = distinct.where(F.shiftrightunsigned("h", 32) < int(2**32 * max_examples / n))
    chosen = cut(named.join(F.broadcast(distinct.select("_k", "toxic", "m")), ["_k", "m"])
                 .select("_k", "text", "toxic").dropDuplicates(["_k"]))

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = np.array([hashed(t) for t in {t for b in batches for text in b["text"] for t in terms(text)}], dtype=np.uint64)
        yield pd.DataFrame({"h": hashes.astype(np.int64)})

    hashes = chosen.select("text").mapInPandas(known, "h long").distinct().toArrow()["h"].to_numpy()
    vocabulary = np.sort(hashes.astype(np.uint64))
    sent = spark.sparkContext.broadcast(Vocabulary(vocabulary))

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(len(sent.value), dtype=np.int64)
        for b in batches:
            for t in b["text"]:
                n += 1
                df[sent.value.known(t)] += 1
        some = np.flatnonzero(df)
        yield pd.DataFrame({"term": np.append(some, -1), "n": np.append(df[some], n)})

    found = docs.select(F.col(text).cast("string").alias("text")).mapInPandas(frequencies, "term long, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(vocabulary))
    df[at[at >= 0]] = n[at >= 0]
    idf = np.log((1 + n[at < 0].sum()) / (1 + df)) + 1
    sent_idf = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [sent.value.count(t) for t in b["text"]]
            w = [(1 + np.log(n)) * sent_idf.value[at] for at, n in found]
            norm = [math.sqrt(float(x @ x)) for x in w]
            yield pd.DataFrame({"id": b["_k"], "toxic": b["toxic"], "norm": norm,
                                "at": [at.astype(np.int32) for at, _ in found], "n": [n.astype(np.int32) for _, n in found],
                                "fold": [folded(at, x / (s or 1)).astype(np.float32) for (at, _), x, s in zip(found, w, norm)]})

    rows = cut(chosen.mapInPandas(
        vectors, "id long, toxic int, norm double, at array<int>, n array<int>, fold array<float>"))
    parts = [rows.where(F.pmod(F.xxhash64("id"), F.lit(PARTS)) == i).toArrow().sort_by("id") for i in range(PARTS)]
    return build_index(parts, vocabulary, idf)


def score(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``evidence`` (ids of the neighbours); columns of
    these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("score double, evidence array<long>")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        index, out = sent.value, []
        for start in range(0, len(texts), BATCH * 4):  # the vectors of so many texts are held at once
            part = texts.iloc[start:start + BATCH * 4]
            vectors = [index.vector(t) for t in part]
            names = [None if not len(v[0]) and not (t and _WORD.search(t)) else (v[0].tobytes(), v[1].tobytes())
                     for t, v in zip(part, vectors)]
            distinct = {n: v for n, v in zip(names, vectors) if n is not None}
            known = dict(zip(distinct, index.scores(list(distinct.values()))))
            known[None] = (index.empty, [])
            out += [known[n] for n in names]
        return pd.DataFrame(out, columns=["score", "evidence"])

    scored = docs.withColumn("_scored", nearest(F.col(text).cast("string")))
    return scored.withColumn("score", F.col("_scored.score")).withColumn("evidence", F.col("_scored.evidence")) \
        .drop("_scored")
