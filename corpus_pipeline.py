"""Corpus pipeline: five stages over ``documents``, each on all rows that its
predecessor kept.  A stage takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet into the shared folder and read again.

1. toxicity: documents with a toxicity score of 0.3 or more go.
2. near_duplicates: one document of each group of near copies stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: every document stays and gets ``mix_pos``, its place in the mixture.
5. sharding: every document gets a shard along the Hilbert curve, and a slot in the
   shard in the order of the mixture.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.config import checkpoint_root
from paytrail.llm import hilbert, lsh_forest, pfair, templates, toxicity
from paytrail.llm.common import packed, table, unpacked
from paytrail.llm.queries import DIMS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(packed(docs, text=F.col("text")), index).where(F.col("score") < toxicity.CUTOFF)
    return scored.select(*unpacked(scored, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lsh_forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A leak is a property of the text: ids may be null or repeated.
    named = packed(docs, digest=F.md5(F.encode("text", "UTF-8")), text=F.col("text"))
    found = templates.leaks(named, table(spark, sf_dir, "benchmark"), key="digest").select(F.col("digest").alias("leaked")).distinct()
    kept = named.join(found, F.col("digest") == F.col("leaked"), "left_anti")
    return kept.select(*unpacked(kept, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = [c for c in docs.columns if c != "mix_pos"]
    return pfair.mix(docs).orderBy("mix_pos").select(*kept, "mix_pos")


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, and size, shard and slot; ``mix_pos`` numbers the rows, each once."""
    placed = hilbert.shard(docs.select("doc_id", "text", "lang", "source", "n_chars", "mix_pos"), DIMS, within="mix_pos").select(
        F.col("mix_pos").alias("at"), "size", "shard", "slot")
    both = packed(docs, place=F.col("mix_pos")).join(placed, F.col("place") == F.col("at"))
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    return both.select(*unpacked(both, kept), "size", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

#: Nearest neighbours, MinHash and approximate quantiles have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage's table stays readable below
    the shared folder until the caller removes it."""
    root = f"{checkpoint_root(spark)}/corpus-pipeline-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
