"""Reply trees into formatted conversations.

Nodes carry a link to their parent. Self-joins that double the reach of every link
(2, 4, 8, ... steps) give each node its root, its depth and the sum of scores on its
path, so a tree of depth d takes log2(d) rounds. Leaves are ranked by that score, and the
nodes on each chosen root-to-leaf path are found by running the doubled links backwards.

Template: ``<|turn|>ROLE<|say|>TEXT<|end|>`` and a line feed for each turn. In roles and
texts one backslash is put between ``<`` and ``|`` wherever they'd make a control string
(and one more where backslashes stand there already), so no text holds a control string
and unescaping gives back the text. The loss mask covers the texts of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, table

TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>\n"


def escape(col: Column) -> Column:
    return F.regexp_replace(col, r"<(\\*)\|", r"<\\$1|")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, r"<\\(\\*)\|", r"<$1|")


def reply_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Root-to-leaf paths of reply trees, the best ``branches`` of each tree.

    ``nodes``: tree, node, parent (null or unknown: a root), score. Returns tree, branch
    (1: the best sum of scores along the path, ties by the leaf's node), depth (0: root) and node.
    Of rows with one tree and node the one of the least parent and score counts. A null score counts as 0; a null tree is a tree, a null node
    is none. Nodes in a cycle, their own parent included, and what answers them reach no root and give no path. No rows give no rows.
    """
    nodes = nodes.where("node is not null").select(F.struct("tree").alias("tree"), "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    nodes = materialise(nodes.groupBy("tree", "node").agg(F.min(F.struct("parent", "score")).alias("p")).select("tree", "node", "p.parent", "p.score"), "chat-nodes")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    links = nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score")
    links = materialise(links.select("tree", "node", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.col("score").alias("total")), "chat-links")
    done, reach, reaches = links.where("up is null"), links.where("up is not null"), []
    while reach.limit(1).count():
        # a link goes on from where it leads to, which has a root by now or a link of the same length
        reaches.append(reach)
        onward = done.unionByName(reach).select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"), F.col("total").alias("_total"))
        longer = reach.join(onward, ["tree", "up"]).select(
            "tree", "node", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("total") + F.col("_total")).alias("total")
        )
        longer = materialise(longer, "chat-links")
        arrived, reach = longer.where("up is null"), longer.where("up is not null")
        if not arrived.limit(1).count():
            break  # a node twice as deep as the last would have arrived, so the rest runs in cycles
        done = done.unionByName(arrived)
    parents = links.where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti")
    best = leaves.withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))).where(F.col("branch") <= branches)
    chosen = materialise(best.select("tree", "branch", "node", F.col("steps").alias("depth")), "chat-paths")
    for k, reach in reversed(list(enumerate(reaches))):
        # every node of a path is met once: its distance from the leaf is one sum of powers of two
        step = chosen.join(reach.select("tree", "node", "up"), ["tree", "node"]).select("tree", "branch", F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth"))
        chosen = materialise(chosen.unionByName(step), "chat-paths")
    return chosen.select("tree.tree", "branch", "depth", "node")


def format_conversations(turns: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each conversation: ``keys``, ``formatted`` and ``n_turns``.

    ``turns`` has ``keys``, ``order`` (sorts the turns), ``role`` and ``text``; null roles and texts are empty.
    """
    turn = F.concat(
        F.lit(TURN), escape(F.coalesce(F.col("role"), F.lit(""))), F.lit(SAY), escape(F.coalesce(F.col("text"), F.lit(""))), F.lit(END)
    )
    ranked = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], turn.alias("_turn"))))
    return turns.groupBy(*keys).agg(ranked.alias("_t")).select(
        *keys, F.array_join(F.transform("_t", lambda t: t["_turn"]), "").alias("formatted"), F.size("_t").cast("long").alias("n_turns")
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text, loss)."""
    pieces = F.split(formatted, r"<\|end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece):
        sides = F.split(F.substring(piece, len(TURN) + 1, 2**31 - 1), r"<\|say\|>")
        role = unescape(sides[0])
        return F.struct(role.alias("role"), unescape(sides[1]).alias("text"), (role == "assistant").alias("loss"))

    return F.transform(pieces, turn)


def chat_nodes(conversations: DataFrame) -> DataFrame:
    """A conversation's rows as a reply chain: each row answers the one before it by turn.

    Rows with the same turn follow each other by role and text; nulls come first.
    """
    at = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(at)).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def op9_reply_chat(spark, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted conversations.

    Empty and null texts make turns with no text; a null conv_id makes one conversation; an empty table leaves conversation -7.
    """
    planted = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(planted).alias("text")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    numbered = materialise(chat_nodes(rows).withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))), "chat-nodes")
    scored = numbered.select("tree", "node", "parent", F.when(F.col("role") == "assistant", F.length("text")).otherwise(0).cast("double").alias("score"))
    paths = reply_paths(scored, branches=1)
    turns = paths.join(numbered, ["tree", "node"]).select("conv_id", "tree", "branch", "depth", "role", "text")
    done = format_conversations(turns, ["tree", "conv_id", "branch"], ["depth"])
    back = done.withColumn("turns", parse(F.col("formatted")))
    said = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"),
        F.sha2(said.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), esc AS (
  SELECT *, '<|turn|>' || regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') || '<|say|>'
    || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10) AS turn_text FROM rows_
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(turn_text)) AS BIGINT) AS formatted_chars
FROM esc GROUP BY conv_id
"""
