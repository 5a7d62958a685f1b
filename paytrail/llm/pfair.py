"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are put into blocks.  While all sources last, a source with weight a
of a total Q owns, for its block j, the window from slot floor(j Q / a) to slot
ceil((j + 1) Q / a); in every slot the released block with the earliest deadline runs.
At any slot each source is then less than one block away from its exact share.  When a
source ends, the others take its slots in proportion to their weights: the share of the
time that it would have had goes to them, and the windows follow.

In turns.  In turn k a source gives its blocks k a to (k + 1) a - 1, or what it has
left.  At the end of a turn every source has exactly its share, so turns are scheduled
apart from each other, and turns in which the same sources give full shares are alike.
Only the turns in which some source ends, and one turn of each row of like turns
between them, are computed, by Spark tasks; the rest are repeats.  Each computed entry
is a block of the table, so the work never exceeds the number of blocks.

One task holds one turn: for each source as many entries as its weight (less, if it has
less blocks).  The driver and every task hold three numbers for each source, which is
the only size that is not divided.  Weights are integers of 1 or more.

Defined results.  Null source: a source named by null.  A source missing in the
given weights: weight 1.  Equal deadlines: the source that sorts first.  Null ids
and texts: rows like any other.  Repeated rows: each gets its own place.  Empty
table: empty result.  A weight below 1: ValueError.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.llm.common import number_in_group, packed, unpacked

BLOCK_ROWS = 32
SCALE = 1000
CELL_ROWS = 50_000
TURNS = 256


def windows(given: list[int], weights: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(release, deadline, source, block) of the blocks of one turn, in which source s
    gives ``given[s]`` of its ``weights[s]`` blocks.

    At share v of the turn, source s has had min(weights[s] v, given[s]) blocks, and the
    slot is the sum of these; a source that ends early leaves the sum's slope."""
    ends = sorted((Fraction(n, a), n, a) for n, a in zip(given, weights) if n < a)
    when = [e[0] for e in ends]
    gone = [0, *accumulate(n for _, n, _ in ends)]
    slope = [sum(weights)]
    for _, _, a in ends:
        slope.append(slope[-1] - a)

    def slot(i: int, a: int, up: bool) -> int:
        past = bisect_right(when, Fraction(i, a)) if ends else 0
        return gone[past] + (-(-i * slope[past] // a) if up else i * slope[past] // a)

    for s, (n, a) in enumerate(zip(given, weights)):
        for i in range(n):
            yield slot(i, a, False), slot(i + 1, a, True), s, i


def turn(given: list[int], weights: list[int]) -> list[tuple[int, int]]:
    """(source, block) in the slots of one turn: earliest deadline first."""
    waiting = sorted(windows(given, weights))
    ready: list[tuple[int, int, int]] = []
    out, at = [], 0
    for slot in range(len(waiting)):
        while at < len(waiting) and waiting[at][0] <= slot:
            heapq.heappush(ready, waiting[at][1:])
            at += 1
        _, s, i = heapq.heappop(ready)
        out.append((s, i))
    return out


def spans(rows: list[int], weights: list[int], block_rows: int) -> list[tuple[int, int, int, int, int]]:
    """(first turn, last turn, sources, slots, rows): rows of like turns, for sources in
    falling order of their last turn.  The ``sources`` first ones take part; ``slots``
    and ``rows`` are those of all turns before."""
    blocks = [-(-n // block_rows) for n in rows]
    last = [(n - 1) // a for n, a in zip(blocks, weights)]
    out, first = [], 0
    ended_blocks = ended_rows = 0
    weight = sum(weights)
    at = len(rows)
    while at:
        end = last[at - 1]
        for lo, hi in ((first, end - 1), (end, end)):
            if lo <= hi:
                out.append((lo, hi, at, ended_blocks + weight * lo, ended_rows + weight * lo * block_rows))
        first = end + 1
        while at and last[at - 1] == end:
            at -= 1
            weight -= weights[at]
            ended_blocks += blocks[at]
            ended_rows += rows[at]
    return out


def tempered(counts: dict[str, int], power: float = 0.7) -> dict[str, int]:
    """Integer weights in proportion to count ** power, about ``SCALE`` in all."""
    total = sum(n ** power for n in counts.values()) or 1
    return {s: max(1, round(SCALE * n ** power / total)) for s, n in counts.items()}


def schedule(spark: SparkSession, counts: dict[str, int], weights: dict[str, int],
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(source, block, slot, pos) of every block: its slot and its first row's place."""
    def turns(s: str) -> int:
        return (-(-counts[s] // block_rows) - 1) // weights[s]

    names = sorted(counts, key=lambda s: (-turns(s), s))
    rows, shares = [counts[s] for s in names], [weights[s] for s in names]
    place = {s: i for i, s in enumerate(sorted(names))}
    order = [place[s] for s in names]  # ties of deadlines go by name
    plan = spans(rows, shares, block_rows)
    held = spark.sparkContext.broadcast((names, rows, shares, order))

    # Blocks shorter than ``block_rows`` are last ones, so they are in turns of which there is one.
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows, shares, order = held.value
        for batch in batches:
            for lo, hi, n, slot, pos in batch.itertuples(index=False, name=None):
                by_name = sorted(range(n), key=order.__getitem__)
                given = [min(shares[s], -(-rows[s] // block_rows) - lo * shares[s]) for s in by_name]
                out, before, size = [], 0, sum(given)
                for k, (j, i) in enumerate(turn(given, [shares[s] for s in by_name])):
                    s = by_name[j]
                    out.append((names[s], lo, hi, shares[s], i, slot + k, size, pos + before))
                    before += min(block_rows, rows[s] - (lo * shares[s] + i) * block_rows)
                for at in range(0, len(out), 10_000):
                    yield pd.DataFrame(out[at:at + 10_000], columns=["_s", "lo", "hi", "a", "i", "slot", "size", "pos"])

    spans_df = spark.createDataFrame(plan, "lo long, hi long, n int, slot long, pos long")
    dealt = spans_df.repartition(max(1, min(len(plan), 2 * spark.sparkContext.defaultParallelism)), "lo")
    done = dealt.mapInPandas(run, "_s string, lo long, hi long, a long, i long, slot long, size long, pos long")
    # Long rows of like turns are dealt to many tasks before they are written out.
    parts = done.withColumn("from", F.explode(F.sequence("lo", "hi", F.lit(TURNS).cast("long")))) \
        .repartition("_s", "i", "from")
    each = parts.withColumn("turn", F.explode(F.sequence("from", F.least(F.col("from") + TURNS - 1, "hi"))))
    past = F.col("turn") - F.col("lo")
    return each.select("_s", (F.col("turn") * F.col("a") + F.col("i")).alias("mix_block"),
                       (F.col("slot") + past * F.col("size")).alias("mix_slot"),
                       (F.col("pos") + past * F.col("size") * block_rows).alias("_pos"))


def mix(df: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
        weights: dict[str, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` plus ``mix_source``, ``mix_block``, ``mix_slot`` and ``mix_pos``, the
    gapless place of the row in the mixture.  Columns of these names are replaced."""
    name = F.coalesce(F.col(source).cast("string"), F.lit("\0null"))
    rows = packed(df, _s=name, _id=F.col(key), _k=F.xxhash64(F.lit(13), F.col(key), F.coalesce(F.col(text), F.lit(""))))
    counts = {r["_s"]: r["count"] for r in rows.groupBy("_s").count().collect()}
    given = {"\0null" if s is None else s: a for s, a in (weights or tempered(counts)).items()}
    shares = {s: given.get(s, 1) for s in counts}
    if any(a < 1 for a in shares.values()):
        raise ValueError("weights are integers of 1 or more")

    # Ranges of a source hold about CELL_ROWS rows, however large it is.
    bits = max(10, (max(counts.values(), default=0) // CELL_ROWS).bit_length())
    n = number_in_group(rows, ["_s"], "_k", [F.col("_id").asc_nulls_first()], "_n", bits)
    n = n.withColumn("mix_block", F.expr(f"_n div {block_rows}"))
    n = n.join(schedule(df.sparkSession, counts, shares, block_rows), ["_s", "mix_block"])
    n = n.withColumn("mix_pos", F.col("_pos") + F.expr(f"_n % {block_rows}"))
    kept = [c for c in df.columns if c not in ("mix_source", "mix_block", "mix_slot", "mix_pos")]
    return n.select(*unpacked(n, kept), F.when(F.col("_s") != "\0null", F.col("_s")).alias("mix_source"),
                    "mix_block", "mix_slot", "mix_pos")
