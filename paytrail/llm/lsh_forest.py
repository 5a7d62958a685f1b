"""N-gram Jaccard join by a MinHash LSH forest.

A text is the set of its ``WORDS``-word shingles (words are runs without ASCII
white space; a shorter text is one shingle).  ``TREES`` prefix tries hold
``START`` hashes of each signature, sorted.  A text is matched at the longest prefix
that it shares with another; matched texts leave but for the head of their node, and
prefixes are shortened for those left, down to the ``depth`` at which a pair just at
the threshold, the hardest to find, is met with a chance of ``TARGET``, whatever the
corpus holds.  A node's head stands for all of its texts, as they share every shorter
prefix too, so no text that leaves takes a neighbour with it.

Every text of a node but its head gives one link, however large the node.  Connected
neighbours form a family.  Within a family every pair is verified exactly on its shingle sets, block against
block inside the tasks: no pairs are written, only the number of links of each
text and a spanning set of links.  A family of many texts is dealt to many tasks.

Exact copies are one text with a count.  Links between different texts found
outside a shared trie node but inside a family are found as well.

Defined results.  Null text: no link, a class of its own row id.  Empty text: linked
with other empty texts only.  Repeated rows: copies.  Null ids: rows like others;
a class is named by its smallest id (null if it has no other).  Classes are told apart
by their texts, so a name may be shared where an id is null or repeated.  Ties: the smallest text digest, then id.  Empty
table: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import components, cut, packed, unpacked

WORDS = 5
THRESHOLD = 0.8
TREES = 24
START = 8
TARGET = 0.9985
SALTS = 64
BLOCK_TEXTS = 512
BLOCK_SHINGLES = 1 << 18

_rng = np.random.default_rng(7)
_MUL = _rng.integers(0, 2**32, TREES * START, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, TREES * START, dtype=np.uint32)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    tokens = text.encode("utf-8", "surrogatepass").split() if text else []
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens))], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    n = len(h) - words + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(words):
        out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(sets: np.ndarray) -> bytes:
    """TREES * START minima, 16 bits each, trie after trie."""
    low = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    best = np.full(TREES * START, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(low), 512):
        part = low[i:i + 512, None] * _MUL + _ADD
        np.minimum(best, part.min(axis=0), out=best)
    best = (best ^ (best >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (best >> np.uint32(16)).astype(">u2").tobytes()


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text digest, n shingles, signature) of each row."""

    @F.pandas_udf("n int, sig binary")
    def sign(texts: pd.Series) -> pd.DataFrame:
        def one(t: str) -> tuple[int, bytes | None]:  # one shingle set is held at a time
            s = shingles(t)
            return len(s), signature(s) if len(s) else None

        return pd.DataFrame([one(t) for t in texts], columns=["n", "sig"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t")).where("t is not null")
    return rows.select("id", F.md5(F.encode("t", "UTF-8")).alias("text"), sign("t").alias("s")) \
        .select("id", "text", "s.n", "s.sig")


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """The values of a binary column, ``width`` bytes each, one a row."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(-1, width)


def _binary(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    ends = np.arange(0, (n + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _descend(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Links inside one sorted run of (tree, key, text), and its first and last row.

    The longest prefix that a row shares with any row before it is the one shared with
    its predecessor.  At that level it is linked to the head of the node, and is itself
    the head of its longer prefixes; rows that are no heads are met by no shorter prefix."""
    levels = list(range(depth, START + 1))
    tree = key = text = heads = None

    def border(edge: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_binary(text), _binary(text), pa.array([edge], pa.int32()),
                                           pa.array([tree], pa.int32()), _binary(key)], names=_TRIE)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        trees = np.asarray(batch.column(0))
        keys, texts = _fixed(batch.column(1), 2 * START), _fixed(batch.column(2), 16)
        first = heads is None
        if first:
            tree, key, text = int(trees[0]), keys[:1], texts[:1]
            heads = {d: text for d in levels}
            yield border(1)
        before = np.concatenate([key, keys[:-1]])
        equal = (keys.reshape(n, START, 2) == before.reshape(n, START, 2)).all(axis=2)
        shared = np.cumprod(equal, axis=1).sum(axis=1)
        shared[trees != np.concatenate([[tree], trees[:-1]])] = 0
        if first:
            shared[0] = 0
        out_a, out_b = [], []
        for d in levels:
            at = np.maximum.accumulate(np.where(shared < d, np.arange(n), -1))
            known = np.concatenate([heads[d], texts])  # -1 is the head that the last batch left
            mine = shared == d
            out_a.append(known[at[mine] + 1])
            out_b.append(texts[mine])
            heads[d] = known[at[-1:] + 1]
        tree, key, text = int(trees[-1]), keys[-1:], texts[-1:]
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [_binary(a), _binary(b), pa.array(np.zeros(len(a), np.int32)),
                 pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())], names=_TRIE)
    if heads is not None:
        yield border(2)


_TRIE = ["a", "b", "edge", "tree", "key"]


def trie_links(texts: DataFrame, depth: int) -> DataFrame:
    """(a, b): links that connect the texts of every trie node of ``depth`` hashes.

    The signatures of all tries are sorted in ranges of (trie, signature, text), so a
    node of any size is dealt to as many ranges as it fills.  Each range makes its own
    links; where a node goes over a border, the last row before and the first row after
    are linked (two rows a range are looked at for this)."""
    trees = F.posexplode(F.array(*[F.substring("sig", 2 * START * t + 1, 2 * START) for t in range(TREES)]))
    rows = texts.where("sig is not null").select(F.unhex("text").alias("text"), trees.alias("tree", "key"))
    order = ["tree", "key", "text"]
    ranges = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut(ranges.mapInArrow(lambda batches: _descend(batches, depth),
                                  "a binary, b binary, edge int, tree int, key binary"))
    inside = found.where("edge = 0").select("a", "b")
    w = Window.orderBy("tree", "key", "a", "edge")
    prefix = F.substring("key", 1, 2 * depth)
    across = found.where("edge > 0").select(
        F.lag("a").over(w).alias("a"), F.col("a").alias("b"), "edge",
        ((F.lag("tree").over(w) == F.col("tree")) & (F.lag(prefix).over(w) == prefix)).alias("one")) \
        .where("edge = 1 and one").select("a", "b")
    return inside.union(across).select(F.lower(F.hex("a")).alias("a"), F.lower(F.hex("b")).alias("b"))


def choose_depth(threshold: float, target: float) -> int:
    """Longest prefix with which a pair at ``threshold`` shares a node with a chance of ``target``."""
    return next((d for d in range(START, 1, -1) if 1 - (1 - threshold ** d) ** TREES >= target), 1)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all sets of ``b``."""
    if len(a) * len(b) <= 64:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b] for x in a], dtype=np.int64)
    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    (ha, ra), (hb, rb) = flat(a), flat(b)
    both = np.intersect1d(ha, hb)
    ca, cb = np.searchsorted(both, ha), np.searchsorted(both, hb)
    ka, kb = (np.flatnonzero((c < len(both)) & (both[np.minimum(c, len(both) - 1)] == h)) if len(both) else
              np.empty(0, np.int64) for c, h in ((ca, ha), (cb, hb)))
    ca, ra, cb, rb = ca[ka], ra[ka], cb[kb], rb[kb]
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, ra, cb, rb = ca[oa], ra[oa], cb[ob], rb[ob]
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for lo in range(0, len(both), 4096):  # 4096 shingles at a time bound the memory
        x, y = np.zeros((len(a), 4096), dtype=np.float32), np.zeros((len(b), 4096), dtype=np.float32)
        i, j = np.searchsorted(ca, [lo, lo + 4096]), np.searchsorted(cb, [lo, lo + 4096])
        x[ra[i[0]:i[1]], ca[i[0]:i[1]] - lo] = 1
        y[rb[j[0]:j[1]], cb[j[0]:j[1]] - lo] = 1
        out += x @ y.T
    return out.astype(np.int64)


def _verify_group(rows: list[tuple], threshold: float) -> list[tuple[str, str, int]]:
    """(text, smallest linked text here, copies linked) of the texts of two blocks."""
    left = {t: (s, c) for t, s, c, side in rows if side != "right"}
    right = {t: (s, c) for t, s, c, side in rows if side != "left"}
    names_a, names_b = sorted(left), sorted(right)
    if not names_a or not names_b:
        return []
    same = names_a == names_b
    common = overlaps([left[t][0] for t in names_a], [right[t][0] for t in names_b])
    size_a = np.array([len(left[t][0]) for t in names_a])
    size_b = np.array([len(right[t][0]) for t in names_b])
    link = common * (1 + threshold) >= threshold * (size_a[:, None] + size_b) - 1e-9
    if same:
        np.fill_diagonal(link, False)
    parent = {t: t for t in [*names_a, *names_b]}

    def top(t: str) -> str:
        while parent[t] != t:
            parent[t] = parent[parent[t]]
            t = parent[t]
        return t

    for i, j in zip(*np.nonzero(link)):
        x, y = top(names_a[i]), top(names_b[j])
        if x != y:
            parent[max(x, y)] = min(x, y)
    copies_a = np.array([left[t][1] for t in names_a], dtype=np.int64)
    copies_b = np.array([right[t][1] for t in names_b], dtype=np.int64)
    out = [(t, top(t), int(n)) for t, n in zip(names_a, link @ copies_b) if n]
    if not same:
        out += [(t, top(t), int(n)) for t, n in zip(names_b, copies_a @ link) if n]
    return out


def verify(members: DataFrame, threshold: float) -> DataFrame:
    """(text, root, linked) from (family, left, right, side, text, copies, body)."""
    dealt = members.repartition("family", "left", "right").sortWithinPartitions("family", "left", "right")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, rows = None, []
        out: list[tuple[str, str, int]] = []
        for b in batches:
            for family, left, right, side, text, copies, body in b.itertuples(index=False, name=None):
                if (family, left, right) != now:
                    out += _verify_group(rows, threshold)
                    now, rows = (family, left, right), []
                rows.append((text, shingles(body), copies, side))
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["text", "root", "linked"])
                out = []
        out += _verify_group(rows, threshold)
        yield pd.DataFrame(out, columns=["text", "root", "linked"])

    return dealt.mapInPandas(run, "text string, root string, linked long")


def _classes(docs: DataFrame, key: str, text: str, threshold: float, target: float,
             block_texts: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, text) with a text, and (text, rep, copies, class, linked) of each text:
    its smallest id, its rows, the smallest text of its class, the rows linked to it."""
    rows = cut(signed(docs, key, text))
    texts = cut(rows.groupBy("text").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                         F.max("n").alias("n"), F.max("sig").alias("sig")))
    depth = choose_depth(threshold, target)
    families = components(trie_links(texts, depth))

    sized = families.join(texts.select(F.col("text").alias("node"), "rep", "copies", "n"), "node")
    # Only families of more than one block have a row here; a large one is met in salts.
    blocks = F.greatest(F.ceil(F.sum(F.lit(1)) / block_texts), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    large = sized.groupBy("root").agg(blocks.alias("blocks")).where("blocks > 1").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sized = sized.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")) \
        .join(large, ["root", "salt"], "left").withColumn("nb", F.coalesce("blocks", F.lit(1)))
    sized = sized.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("nb")).cast("int"))
    sized = cut(sized.select(F.col("root").alias("family"), F.col("node").alias("text"), "rep", "copies", "nb", "block"))
    # Only the row with the smallest id of each text brings its body along.
    bodies = docs.select(F.col(key).alias("rep"), F.col(text).cast("string").alias("body")).where("body is not null")
    found = bodies.alias("d").join(sized.alias("s"), F.col("d.rep").eqNullSafe(F.col("s.rep"))) \
        .where(F.md5(F.encode("body", "UTF-8")) == F.col("text")) \
        .select("family", "text", "copies", "nb", "block", "body")
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(
        F.least("block", j).alias("left"), F.greatest("block", j).alias("right"),
        F.when(F.col("block") == j, "both").when(F.col("block") < j, "left").otherwise("right").alias("side"))))
    members = found.withColumn("p", pairs).select("family", "p.left", "p.right", "p.side", "text", "copies", "body")
    links = cut(verify(members, threshold))

    classes = components(links.select(F.col("text").alias("a"), F.col("root").alias("b")))
    per_text = texts.select("text", "rep", "copies") \
        .join(classes.select(F.col("node").alias("text"), F.col("root").alias("class")), "text", "left") \
        .join(links.groupBy("text").agg(F.sum("linked").alias("linked")), "text", "left") \
        .withColumn("class", F.coalesce("class", "text"))
    return rows, per_text


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         target: float = TARGET, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """(key, class_id, n_links, n_copies) of every row: the smallest id of the texts
    connected by links, the number of other rows with a similarity of ``threshold``
    or more (copies included), and the rows with an equal text."""
    rows, per_text = _classes(docs, key, text, threshold, target, block_texts)
    names = per_text.groupBy("class").agg(F.min("rep").alias("class_id"))
    per_text = per_text.join(names, "class").select(
        "text", "class_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("copies").alias("n_copies"))
    with_text = rows.select("id", "text").join(per_text, "text").select(
        F.col("id").alias(key), "class_id", "n_links", "n_copies")
    without = docs.where(F.col(text).isNull()).select(
        F.col(key), F.col(key).alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return with_text.unionByName(without)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of the smallest id and then text digest (a null id
    comes last); every column stays.  Rows are told apart by (id, text), so neither null
    nor repeated ids drop another text.  A null text is like no other: all its rows stay."""
    _, per_text = _classes(docs.select(key, text), key, text, THRESHOLD, TARGET, BLOCK_TEXTS)
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "text")).alias("first")
    chosen = per_text.groupBy("class").agg(first).select(F.col("first.rep").alias("_id"), F.col("first.text").alias("_t"))
    digest = F.md5(F.encode(F.col(text).cast("string"), "UTF-8"))
    kept = packed(docs.where(F.col(text).isNotNull()), own_id=F.col(key), digest=digest).join(
        chosen, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_t")), "left_semi")
    one = kept.dropDuplicates(["digest"])
    return one.select(*unpacked(one, docs.columns)).unionByName(docs.where(F.col(text).isNull()))
