"""Reply trees to conversations: DataFrame and SQL functions only.

Rows of a tree name their parent. Root-to-leaf paths are found by iterative
self-joins that double the steps taken: round k joins each row's jump of
2**k steps with the jump of the row it lands on, and adds up the scores on
the way, so a thread of n turns takes log2(n) rounds and each round is a
written table. Leaves rank by the score of their whole path; the best
``branches`` of a tree are spelled out by descending through the kept jumps
(a binary number for each distance), and each becomes one conversation.

A turn is ``<turn>### role``, a line break, the text and ``</turn>``. In
roles and texts ``\\`` becomes ``\\b``, ``<`` ``\\l`` and ``#`` ``\\h`` (and a
line break in a role ``\\n``), so no text can hold a marker and all of it
comes back. The loss mask has the code-point spans of the texts of
``learn_role``.

Null texts, roles and scores count as empty or 0; null tree ids are one tree
of their own; a parent that isn't there makes its row a root; of rows with one
node id in a tree the first by role and text stays (ids are unique by
contract; ``linear_threads`` makes them so); rows in a cycle of replies are on
no root-to-leaf path and so in no conversation. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common as C

OPEN, CLOSE = "<turn>### ", "</turn>"
MAX_ROUNDS = 40


def escape(c: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    """Each backslash leads a code, so codes can be put back one by one,
    that of the backslash last."""
    for raw, code in (("\n", "\\n"), ("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def linear_threads(rows: DataFrame, tree: str, order: list[str], role: str = "role", text: str = "text") -> DataFrame:
    """(tree, node, parent, role, text, score) of threads in which each row
    replies to the one before it; ties in ``order`` go by role and text.
    The score is the text's length."""
    by = Window.partitionBy(tree).orderBy(*order, role, text)
    nth = F.row_number().over(by).cast("bigint")
    return (rows.select(F.col(tree).alias("tree"), nth.alias("node"), F.col(role).alias("role"), F.col(text).alias("text"))
            .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                    F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("score")))


def _jumps(rows: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jumps of 1, 2, 4 ... steps (t, node, up), and (t, node, total): the
    score from each row that has a root up to it."""
    ids = rows.select("t", "node")
    state = rows.select("t", "node", F.col("parent").alias("up"), F.col("score").alias("total"))
    up = ids.select("t", F.col("node").alias("up"), F.lit(True).alias("there"))
    state = C.stage(state.join(up, ["t", "up"], "left").select("t", "node", F.when(F.col("there"), F.col("up")).alias("up"), "total"),
                    "reply-jumps")
    kept = []
    while len(kept) < MAX_ROUNDS:
        open_ = state.where("up is not null")
        n = open_.count()
        if not n or 1 << len(kept) > state.count():
            break
        kept.append(open_.select("t", "node", "up"))
        over = state.select("t", F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"))
        state = C.stage(open_.join(over, ["t", "up"]).select("t", "node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"))
                        .unionByName(state.where("up is null")), "reply-jumps")
    return kept, state.where("up is null").select("t", "node", "total")


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, path_score, turn, role, text): the turns of the best
    ``branches`` paths of each tree; ties in score go to the lesser leaf."""
    rows = nodes.select(_key(F.col("tree")).alias("t"), "tree", F.col("node").cast("bigint").alias("node"),
                        F.col("parent").cast("bigint").alias("parent"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score"), F.lit(0)).alias("score"))
    best = F.min_by(F.struct("tree", "parent", "score", "role", "text"), F.struct("role", "text", "parent"))
    rows = C.stage(rows.groupBy("t", "node").agg(best.alias("r")).select("t", "node", "r.*"), "reply-nodes")
    jumps, totals = _jumps(rows)
    parents = rows.select("t", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = totals.join(parents, ["t", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("t").orderBy(F.desc("total"), "node"))
    path = (leaves.withColumn("branch", rank).where(F.col("branch") <= branches)
            .select("t", "branch", F.col("total").alias("path_score"), "node", F.lit(0).cast("bigint").alias("steps")))
    for k in range(len(jumps) - 1, -1, -1):
        further = (path.join(jumps[k], ["t", "node"])
                   .select("t", "branch", "path_score", F.col("up").alias("node"), (F.col("steps") + (1 << k)).alias("steps")))
        path = C.stage(path.unionByName(further), "reply-paths")
    return (path.join(rows.select("t", "node", "tree", "role", "text"), ["t", "node"])
            .select("tree", "t", "branch", "path_score", (-F.col("steps")).alias("turn"), "role", "text"))


def conversations(nodes: DataFrame, branches: int = 1, learn_role: str = "assistant") -> DataFrame:
    """(tree, branch, path_score, formatted, loss_spans): one row a chosen
    path; ``loss_spans`` are (start, length) in code points from 0."""
    turns = best_paths(nodes, branches)
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    turns = turns.select("tree", "t", "branch", "path_score", "turn", (F.col("role") == learn_role).alias("learn"),
                         head.alias("head"), escape(F.col("text")).alias("body"))
    before = Window.partitionBy("t", "branch").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.length("head") + F.length("body") + len(CLOSE)
    turns = turns.withColumn("at", F.coalesce(F.sum(whole.cast("bigint")).over(before), F.lit(0).cast("bigint")))
    span = F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length"))
    parts = turns.groupBy("t", "branch").agg(
        F.first("tree").alias("tree"), F.first("path_score").alias("path_score"),
        F.sort_array(F.collect_list(F.struct("turn", F.concat("head", "body", F.lit(CLOSE)).alias("s")))).alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("learn"), span))).alias("loss_spans"))
    return parts.select("tree", "branch", "path_score", F.array_join(F.col("turns.s"), "").alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    raw = F.split(formatted, CLOSE)
    raw = F.slice(raw, 1, F.size(raw) - 1)

    def turn(x):
        x = F.substr(x, F.lit(len(OPEN) + 1))
        role = F.substring_index(x, "\n", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(x, F.length(role) + 2)).alias("text"))
    return F.transform(raw, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, end to end."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
