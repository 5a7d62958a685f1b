"""Vector code compression (product quantisation) by member-resident Lloyd.

Every vector becomes integers (floor of ``SCALE`` times the component) and is cut into
``PARTS`` equal parts; each position has its own codebook.  The members of an entry live
in the partitions of their (position, entry, salt): the owners add up their resident
members, and after the update of the entries every owner looks for members that are
nearer to another entry now.  Only these are shuffled to their new owners; all others
stay in the partition where they are.

Members are held by Spark's cache on memory and disk, whose lost blocks are computed
again, and every ``CUT_EVERY`` rounds their lineage is cut in the shared checkpoint
folder.  Equal parts of a batch are one member with a count, so that a very common
vector takes a row for each batch; the salt deals the members of a common entry to many
tasks.  The codebooks (PARTS * ENTRIES parts, whatever the input) are the only data that
pass the driver.  Codes come from a last pass over the vectors with the final codebooks.

Defined results.  Dropped: null vectors, vectors with null or non-finite components or
with one whose size exceeds ``LARGEST`` (squared errors must fit a long), empty vectors,
lengths that are no multiple of ``PARTS``, and lengths other than that of the first kept
vector.  Seeds are the first ENTRIES rows by (vec_id, integers), null ids last; with
fewer rows the codebooks have fewer entries.  Repeated rows and null ids: rows like
others.  Null labels: one group.  Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import cut, salted, total_by_salt

SCALE = 4096.0
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 27
SALTS = 64
CUT_EVERY = 4
#: Vectors compared at once inside a task (times entries and part length, 8 bytes each).
BLOCK = 1024
_MEMBERS = "pos int, entry int, part array<int>, n long"


def integers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The kept rows with their integer components as ``ints``."""
    x = F.col(vector)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * SCALE < float(LARGEST)))
    return vectors.where(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % PARTS == 0)).where(usable) \
        .withColumn("ints", whole.cast("array<int>"))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part (ties: the lower index) and its squared distance."""
    entry, far = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for at in range(0, len(parts), BLOCK):
        d = ((parts[at:at + BLOCK, None, :] - book[None]) ** 2).sum(2)
        entry[at:at + BLOCK] = d.argmin(1)
        far[at:at + BLOCK] = d.min(1)
    return entry, far


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _members(pos: np.ndarray, entry: np.ndarray, parts: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    flat = pa.array(parts.astype(np.int32).ravel())
    offsets = pa.array(np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1])
    return pa.RecordBatch.from_arrays(
        [pa.array(pos.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.ListArray.from_arrays(offsets, flat),
         pa.array(n.astype(np.int64))], names=["pos", "entry", "part", "n"])


def _first_members(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            whole = _matrix(b.column(0), books.shape[0] * books.shape[2])
            for pos, book in enumerate(books):
                parts, n = np.unique(whole[:, pos * book.shape[1]:(pos + 1) * book.shape[1]], axis=0, return_counts=True)
                yield _members(np.full(len(parts), pos), nearest(parts, book)[0], parts, n)
    return run


def _reassigned(books: np.ndarray, moved: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members that stay with their entry, or those that move, with the new entry."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            pos, entry = b.column("pos").to_numpy(), b.column("entry").to_numpy()
            parts = _matrix(b.column("part"), books.shape[2])
            new = np.empty(len(pos), np.int64)
            for p in np.unique(pos):
                new[pos == p] = nearest(parts[pos == p], books[p])[0]
            take = (new != entry) if moved else (new == entry)
            if take.any():
                yield _members(pos[take], new[take], parts[take], b.column("n").to_numpy()[take])
    return run


def _owner_sums(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each (position, entry) of a partition: its members and their sum."""
    k = books.shape[1]

    def run(batches):
        total = np.zeros((books.shape[0] * k, books.shape[2]), np.int64)
        count = np.zeros(books.shape[0] * k, np.int64)
        for b in batches:
            slot = b.column("pos").to_numpy().astype(np.int64) * k + b.column("entry").to_numpy()
            n = b.column("n").to_numpy()
            np.add.at(total, slot, _matrix(b.column("part"), books.shape[2]) * n[:, None])
            np.add.at(count, slot, n)
        used = np.nonzero(count)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used // k, pa.int32()), pa.array(used % k, pa.int32()), pa.array(count[used]),
             pa.array(total[used].tolist(), pa.list_(pa.int64()))], names=["pos", "entry", "n", "total"])
    return run


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with every used entry at the floor of its members' mean."""
    parts = members.select("pos", "entry", "part", "n").mapInArrow(
        _owner_sums(books), "pos int, entry int, n long, total array<long>")
    dims = range(books.shape[2])
    rows = parts.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *[
        F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in dims]).collect()  # PARTS * ENTRIES rows at most
    new = books.copy()
    for r in rows:
        new[r["pos"], r["entry"]] = [r[f"t{i}"] // r["n"] for i in dims]
    return new


def fit(kept: DataFrame, key: str = "vec_id", entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (position, entry, component) after ``rounds`` rounds; None without rows.
    ``kept`` has ``ints`` of one length (:func:`same_length`)."""
    seeds = [r[0] for r in kept.select("ints", key).orderBy(F.col(key).asc_nulls_last(), "ints").limit(entries).collect()]
    if not seeds:
        return None
    books = np.array(seeds, np.int64).reshape(len(seeds), PARTS, -1).transpose(1, 0, 2)

    def owned(rows: DataFrame) -> DataFrame:
        return salted(rows, ["pos", "entry"], "part", SALTS)

    partitions = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = owned(kept.select("ints").mapInArrow(_first_members(books), _MEMBERS)).persist(StorageLevel.MEMORY_AND_DISK)
    for r in range(1, rounds + 1):
        books = _updated(members, books)
        if r == rounds:
            break
        rows = members.select("pos", "entry", "part", "n")
        stay = rows.mapInArrow(_reassigned(books, False), _MEMBERS).withColumn(
            "salt", F.pmod(F.xxhash64("part"), F.lit(SALTS)).cast("int"))
        # coalesce() moves no rows; it only keeps the number of partitions from growing with the rounds.
        after = stay.union(owned(rows.mapInArrow(_reassigned(books, True), _MEMBERS))).coalesce(partitions)
        after = cut(after) if r % CUT_EVERY == 0 else after
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        after.count()
        members.unpersist()
        members = after
    members.unpersist()
    return books


def same_length(kept: DataFrame, key: str = "vec_id") -> DataFrame:
    """The rows whose vector is as long as that of the first row by (key, integers)."""
    first = kept.select(F.size("ints").alias("n"), "ints", key).orderBy(F.col(key).asc_nulls_last(), "ints").limit(1).collect()
    return kept.where(F.size("ints") == (first[0]["n"] if first else 0))


def encode(kept: DataFrame, books: np.ndarray, key: str = "vec_id", label: str = "label") -> DataFrame:
    """(key, label, code, error) of every row."""
    types = dict(kept.dtypes)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            whole = _matrix(b.column(2), books.shape[0] * books.shape[2])
            found = [nearest(whole[:, p * books.shape[2]:(p + 1) * books.shape[2]], book) for p, book in enumerate(books)]
            codes = np.stack([e for e, _ in found], 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(["".join(f"{x:02x}" for x in row) for row in codes.tolist()]),
                 pa.array(np.sum([d for _, d in found], 0))], names=[key, label, "code", "error"])

    return kept.select(key, label, "ints").mapInArrow(
        run, f"`{key}` {types[key]}, `{label}` {types[label]}, code string, error long")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` and ``label_error``, the error summed over equal labels."""
    group = F.struct(F.col(label).alias("label"))
    rows = salted(coded.withColumn("group", group).withColumn("spread", F.struct("error", "code")), ["group"], "spread")
    sums = total_by_salt(rows.groupBy("group", "salt").agg(F.sum("error").alias("label_error")), ["group"],
                         {"label_error": F.sum})
    return rows.join(sums, ["group", "salt"]).select(*coded.columns, "label_error")


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every kept row."""
    kept = same_length(integers(vectors.select(key, vector, label), vector), key)
    books = fit(kept, key, entries, rounds)
    if books is None:
        return kept.select(key, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    return with_label_error(encode(kept, books, key, label), label).select(
        key, "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
