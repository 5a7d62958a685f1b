"""Registered queries of this subpackage and the DuckDB SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.llm import (bloom_cascade, filter_audit, hilbert, html_text, line_dedup, line_frequency, lsh_forest, pfair,
                          reply_trees, resident_lloyd, suffix_tree, templates, toxicity)
from paytrail.llm.common import bucket, table

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
# The rules that op3 applies.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
# Words of host names that put a host on the block list.
LISTED_WORDS = "ads adult bet bets casino farm pills poker porn spam track tracker viagra win xxx".split()
DIMS = ["lang", "source", "n_chars", "doc_id"]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], rows.schema)
    paths = reply_trees.reply_paths(reply_trees.chain(rows.union(extra)))
    out = reply_trees.format_paths(paths).withColumn("turns", reply_trees.parse(F.col("formatted")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("loss", lambda s: reply_trees.unescape(
        F.substr("formatted", (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))), "")
    return out.withColumn("_loss", trained).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(flat, "UTF-8"), 256).alias("turns_sha256"), F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard(table(spark, sf_dir, "documents"), DIMS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), F.col("h").alias("curve"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = bloom_cascade.hosts_with(pages, LISTED_WORDS)
    return bloom_cascade.judge(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.judge(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_tree.score(docs, suffix_tree.fit(docs))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.join(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= toxicity.CUTOFF).cast("int").alias("predicted"), "evidence")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.xxhash64("text").cast("string").alias("text"))
    return pfair.mix(docs).select("doc_id", "source", "mix_block", "mix_slot", "mix_pos")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.dedupe(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resident_lloyd.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_reply_trees": op1,
    "op2_hilbert_sharding": op2,
    "op3_bloom_cascade": op3,
    "op4_template_decontamination": op4,
    "op5_line_frequency": op5,
    "op6_suffix_tree": op6,
    "op7_lsh_forest_join": op7,
    "op8_line_blocks": op8,
    "op9_toxicity_neighbours": op9,
    "op10_pfair_mixing": op10,
    "op11_line_dedup": op11,
    "op12_filter_audit": op12,
    "op13_resident_lloyd": op13,
}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_URL = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
_HOST = (f"translate(regexp_extract(coalesce(url, ''), {_URL}, 1), "
         "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")



def _lloyd_sql(rounds: int = 6) -> str:
    """Six rounds written out: the codebook of each follows from the one before."""
    steps = ["""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """x AS (SELECT r, (i - 1) // (len(e) // 8) AS pos, (i - 1) % (len(e) // 8) AS dim, CAST(floor(4096 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS x
        FROM v, unnest(range(1, len(e) + 1)) AS u(i))""",
             "b0 AS (SELECT pos, CAST(r - 1 AS BIGINT) AS entry, dim, x AS c FROM x WHERE r <= 16)"]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (SELECT r, pos, entry, sum((x - c) * (x - c)) AS d FROM x JOIN b{i} USING (pos, dim) GROUP BY r, pos, entry)""")
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, pos, entry, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r, pos ORDER BY d, entry) = 1)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT pos, entry, dim, CAST(floor(sum(x) / count(*)) AS BIGINT) AS c
                FROM a{i} JOIN x USING (r, pos) GROUP BY pos, entry, dim)""")
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT pos, entry, dim, coalesce(m{i}.c, b{i}.c) AS c
                FROM b{i} LEFT JOIN m{i} USING (pos, entry, dim))""")
    return "WITH " + ", ".join(steps) + f""",
        coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
        named AS (SELECT * FROM v JOIN coded USING (r)),
        books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos, entry, dim)) AS h FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
        FROM named, books"""


SQL: dict[str, str] = {
    "op1_reply_trees": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               cast(sum(24 + length(role) + length(text) + length(text) - length(replace(text, '\', ''))
                        + (length(text) - length(replace(text, '<|', ''))) // 2) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id""",
    "op3_bloom_cascade": f"""
        WITH parts AS (SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), {_URL}, 2) AS path FROM pages),
        found AS (SELECT *, CASE
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN regexp_matches(host, '(^|[.])([^.]*-)?({"|".join(LISTED_WORDS)})-')
                         OR regexp_matches(host, '-({"|".join(LISTED_WORDS)})(-[^.]*)?([.]|$)') THEN 'block'
                    ELSE 'allow' END AS verdict FROM found""",
    "op11_line_dedup": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
        keyed AS (SELECT *, translate(trim(line, {_WHITE}), {_LOWER}) AS key FROM lines),
        common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key
                   HAVING count(DISTINCT doc_id) >= 5),
        marked AS (SELECT k.*, coalesce(k.doc_id <> c.last, false) AS gone FROM keyed k LEFT JOIN common c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY r, doc_id""",
    "op12_filter_audit": r"""
        WITH RECURSIVE docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
        words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first
                  FROM docs),
        failed AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
                          regexp_matches(text, '[#$%&*|]'), doc_id > first] AS f FROM words),
        marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
        counted AS (SELECT part, f, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
                    FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, f),
        orders AS (SELECT '' AS o UNION ALL
                   SELECT o || c FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(o, c)),
        steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders WHERE length(o) = 5),
        placed AS (SELECT part, o, step, n, good, toxic, f[ascii(o[step]) - 64] AS fails,
                      len(list_filter(range(1, step), lambda i: f[ascii(o[i]) - 64])) > 0 AS gone,
                      len(list_filter(f, lambda x: x)) AS n_fails FROM counted, steps),
        counts AS (SELECT part, o, step,
                          coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept,
                          coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
                          coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
                          coalesce(sum(n) FILTER (fails AND n_fails = 1), 0) AS unique_fails,
                          coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost,
                          coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost FROM placed GROUP BY part, o, step)
        SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley FROM counts""",
    "op13_resident_lloyd": _lloyd_sql(),
}
