"""Chat formatting of reply trees.

Messages point to their parent.  ``reply_paths`` finds every root-to-leaf path by
doubling self-joins (round k joins each message with its ancestor 2^k steps up,
so a thread of n messages needs log2(n) rounds), ranks the branches of a tree by
the sum of their message scores, and keeps the best ones.  ``format_paths`` writes
each kept path as one conversation.

Defined results.  Null text or role: empty.  Null tree id: a tree of its own.
A parent that does not exist, is null, or is the message itself: a root.  Equal
(tree, message) ids: the row with the smallest (role, text) stands for them.
Messages on a parent cycle have no root and lie on no path.  Equal branch scores:
the smaller leaf id ranks first.  Extra columns are ignored, no table columns are
reused as internal names.  Empty input: empty output.

One conversation is one output value, as large as its own text; nothing else is
gathered per tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import cut

START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    """Put a backslash into every ``<|``; backslashes are doubled first."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    # \n is only a line break where its backslash is not itself escaped.
    return unescape(F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def chain(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the row before it in
    the order (turn, role, text); all rows stay, also repeated ones."""
    rows = turns.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("msg", F.row_number().over(order).cast("long"))
    return rows.select("tree", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"),
                       "role", "text", F.length("text").cast("double").alias("score"))


def reply_paths(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """Root-to-leaf paths of ``messages`` (tree, msg, parent, role, text, score).

    Rows (tree, leaf, branch_rank, path_score, depth, role, text), one for each
    message of each kept path, depth 0 at the root.  ``keep`` limits the branches
    per tree (None: all).
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    best = F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                          score.alias("score"), F.col("parent").alias("parent")))
    rows = messages.withColumn("_t", F.coalesce(F.col("tree").cast("string"), F.lit("\0null")))
    rows = rows.where(F.col("msg").isNotNull()).groupBy("_t", "tree", "msg").agg(best.alias("m"))
    rows = cut(rows.select("_t", "tree", "msg", "m.parent", "m.role", "m.text", "m.score"))

    ids = rows.select("_t", F.col("msg").alias("parent"), F.lit(True).alias("known"))
    links = rows.select("_t", "msg", "parent", "score").join(ids, ["_t", "parent"], "left")
    real = F.col("known") & (F.col("parent") != F.col("msg"))
    # up: ancestor 2^k above; steps and total: messages and score from here up to before it.
    jump = cut(links.select("_t", "msg", F.when(real, F.col("parent")).alias("up"),
                            F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")))
    size = jump.groupBy("_t").count().agg(F.max("count")).head()[0] or 0
    # Only messages still below a known ancestor take part in a round; rooted ones are done.
    climbing, rooted = jump.where("up is not null"), jump.where("up is null")
    jumps = []
    for _ in range(max(1, size.bit_length())):
        if climbing.limit(1).count() == 0:
            break
        jumps.append(climbing.select("_t", "msg", "up"))
        above = climbing.unionByName(rooted).select(
            "_t", F.col("msg").alias("up"), F.col("up").alias("up2"),
            F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        jump = cut(climbing.join(above, ["_t", "up"]).select(
            "_t", "msg", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("total") + F.col("total2")).alias("total")))
        climbing, rooted = jump.where("up is not null"), rooted.unionByName(jump.where("up is null"))

    rooted = cut(rooted)  # one table: an anti-join over its parts would read the other side once for each
    inner = links.where(real).select("_t", F.col("parent").alias("msg")).distinct()
    leaves = rooted.join(inner, ["_t", "msg"], "left_anti")
    rank = Window.partitionBy("_t").orderBy(F.col("total").desc(), "msg")
    leaves = leaves.withColumn("branch_rank", F.row_number().over(rank))
    if keep is not None:
        leaves = leaves.where(F.col("branch_rank") <= keep)

    path = leaves.select("_t", F.col("msg").alias("leaf"), "branch_rank", F.col("total").alias("path_score"),
                         "msg", (F.col("steps") - 1).alias("depth"))
    for k in reversed(range(len(jumps))):
        higher = path.join(jumps[k], ["_t", "msg"]).select(
            "_t", "leaf", "branch_rank", "path_score", F.col("up").alias("msg"),
            (F.col("depth") - (1 << k)).alias("depth"))
        path = path.unionByName(higher)
        if k:
            path = cut(path)
    return path.join(rows.select("_t", "msg", "tree", "role", "text"), ["_t", "msg"]).select(
        "tree", "leaf", "branch_rank", "path_score", "depth", "role", "text")


def format_paths(paths: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per path: (tree, leaf, branch_rank, path_score, formatted, loss).

    ``loss`` holds the [from, to) code-point spans of ``formatted`` that are
    trained on: the escaped texts of the ``trained`` roles.
    """
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rows = paths.withColumn("_head", head).withColumn("_body", body)
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit(END + "\n")))
    key = ["tree", "leaf", "branch_rank", "path_score"]
    so_far = Window.partitionBy(*key).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_piece")).over(so_far), F.lit(0)) + F.length("_head")
    rows = rows.withColumn("_from", start).select(
        *key, F.struct("depth", F.col("_piece").alias("piece"), F.col("role").isin(*trained).alias("on"),
                       F.col("_from").alias("from"),
                       (F.col("_from") + F.length("_body")).alias("to")).alias("turn"))
    one = rows.groupBy(*key).agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return one.select(
        *key, F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["on"]),
                    lambda t: F.struct(t["from"].alias("from"), t["to"].alias("to"))).alias("loss"))


def parse(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    pieces = F.regexp_extract_all(formatted, F.lit(r"(?s)<\|im_start\|>(.*?)<\|im_end\|>\n"), F.lit(1))
    return F.transform(pieces, lambda p: F.struct(
        _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))
