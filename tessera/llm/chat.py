"""Chat formatting of reply trees, in DataFrame operations only.

Input: one row per message with its tree, its id, its parent (null: a root), role,
text and a score. Iterative self-joins double the known stretch of ancestors each
round (``2^k`` rounds reach depth ``2^k``), which gives every message its root, its
depth and the sum of scores on its path; leaves stand for root-to-leaf paths. Per
tree the paths are ranked by score, and the stretches, applied from the longest to
the shortest, lead from each chosen leaf back over its path. Each path becomes one
formatted conversation with a loss mask.

Template: every message is ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|`` (in roles also a line feed
becomes ``\\n``), so no control string can come from a text, and ``unescape``
restores it. The loss mask has one span (first code point, length) for each text
of the trained role.

Defined results: null roles and texts are empty; a message whose parent is missing
is a root; null trees and ids are values like others (a null parent is none); messages on a cycle reach no root and belong to no path; repeated rows
of one id are collapsed to one (the least by role and text); ties of scores go to
the smaller leaf id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_position
from .staging import stage

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """A text without control strings."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column, role: bool = False) -> Column:
    """What ``escape`` was given. Doubled backslashes split the text, so what is
    left in the pieces can only be the other escapes."""
    def piece(p: Column) -> Column:
        p = F.replace(p, F.lit("<\\|"), F.lit("<|"))
        return F.replace(p, F.lit("\\n"), F.lit("\n")) if role else p
    # '<' and '\\|' are never parted by a doubled backslash: '<\\\\|' reads '<', '\\\\', '|'
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), piece), "\\")


def _paths(nodes: DataFrame, top: int) -> DataFrame:
    """Messages on the ``top`` best root-to-leaf paths of each tree:
    ``tree, leaf, rank, score, node, depth``."""
    known = nodes.select("tree", "node")
    up = (nodes.alias("n").join(
        known.alias("p"), (F.col("n.tree") == F.col("p.tree")) & (F.col("n.parent") == F.col("p.node")), "left")
        .select("n.tree", "n.node", F.col("p.node").alias("up"),
                F.when(F.col("p.node").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("steps"),
                F.col("n.score").alias("path"), F.col("n.score").alias("score")))
    # up: the ancestor 2^k steps away (null beyond the root); steps, path: what lies below it
    jump = stage(up.select("tree", "node", "up", "steps", F.col("path").alias("sum")), "jumps")
    jumps = []
    longest = F.max(F.when(F.col("up").isNotNull(), F.col("steps")))
    n = nodes.count()
    while True:
        reach = jump.agg(longest).first()[0]
        if reach is None or 2 ** len(jumps) > n:  # all at their root; or only cycles left
            break
        jumps.append(jump)
        # only messages that are not at their root yet take another jump
        a, b = jump.where("up IS NOT NULL").alias("a"), jump.alias("b")
        further = (a.join(b, (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.node")), "left")
                   .select("a.tree", "a.node", F.col("b.up").alias("up"),
                           (F.col("a.steps") + F.coalesce("b.steps", F.lit(0))).alias("steps"),
                           (F.col("a.sum") + F.coalesce("b.sum", F.lit(0.0))).alias("sum")))
        jump = stage(jump.where("up IS NULL").union(further), "jumps")
    done = jump.where("up IS NULL").select("tree", "node", F.col("steps").alias("depth"), "sum")
    parents = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti")
    # row_number <= top is also applied before the shuffle, so few leaves of a tree travel
    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("sum"), "node"))
    marked = leaves.withColumn("rank", place).where(F.col("rank") <= top).select(
        "tree", F.col("node").alias("leaf"), "rank", F.col("sum").alias("score"), "node")
    for jump in reversed(jumps):
        more = (marked.alias("m").join(
            jump.alias("j"), (F.col("m.tree") == F.col("j.tree")) & (F.col("m.node") == F.col("j.node")))
            .where("j.up IS NOT NULL").select("m.tree", "m.leaf", "m.rank", "m.score", F.col("j.up").alias("node")))
        marked = stage(marked.union(more), "paths")
    return marked.join(done.select("tree", "node", "depth"), ["tree", "node"])


def format_chats(messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent",
                 role: str = "role", text: str = "text", score: str | None = None, top: int = 1,
                 trained: str = "assistant") -> DataFrame:
    """One formatted conversation for each of the ``top`` best paths of a tree.

    A path's score is the sum of its messages' scores (1 each without a score
    column: the deepest path is best). Returns ``tree, leaf, rank, score,
    n_turns, formatted, loss`` (array of ``start, length`` in code points).
    """
    # ids as structs: a null id inside one is equal to itself
    rows = (messages.select(
        F.struct(F.col(tree).alias("id")).alias("tree"), F.struct(F.col(node).alias("id")).alias("node"),
        F.when(F.col(parent).isNotNull(), F.struct(F.col(parent).alias("id"))).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(1.0)).alias("score"))
        .groupBy("tree", "node").agg(F.min(F.struct("role", "text", "parent", "score")).alias("m"))
        .select("tree", "node", "m.*"))
    rows = stage(rows, "messages")
    steps = _paths(rows.select("tree", "node", "parent", "score"), top)
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = steps.drop("score").withColumnRenamed("rank", "place").join(rows, ["tree", "node"]).select(
        "tree", "leaf", "place", F.struct(
            F.col("depth"), F.length(head).alias("head"), F.length(escape(F.col("text"))).alias("body"),
            (F.col("role") == trained).alias("train"),
            F.concat(head, escape(F.col("text")), F.lit(END + "\n")).alias("out"), F.col("score")).alias("t"))
    tail = len(END) + 1
    paths = turns.groupBy("tree", "leaf", "place").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # running offsets: one pass that appends the trained spans
    none = F.lit(None).cast("array<struct<start:int,length:int>>")
    mask = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.coalesce(none, F.array()).alias("loss")),
        lambda a, t: F.struct(
            (a["at"] + t["head"] + t["body"] + tail).alias("at"),
            F.when(t["train"], F.concat(a["loss"], F.array(F.struct(
                (a["at"] + t["head"]).alias("start"), t["body"].alias("length")))))
            .otherwise(a["loss"]).alias("loss")),
        lambda a: a["loss"])
    return paths.select(
        F.col("tree.id").alias("tree"), F.col("leaf.id").alias("leaf"), F.col("place").alias("rank"),
        F.aggregate("turns", F.lit(0.0), lambda a, t: a + t["score"]).alias("score"),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"), mask.alias("loss"))


def linear_replies(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Rows of linear conversations as replies: ``node`` is the row's place in the
    whole table, the parent is the row before it in its conversation. Places come
    from range partitions, so a huge conversation is spread over many tasks."""
    placed = with_position(rows, [tree, *order], "node")
    first = placed.groupBy(tree).agg(F.min("node").alias("first"))
    return (placed.alias("r").join(first.alias("f"), F.col(f"r.{tree}").eqNullSafe(F.col(f"f.{tree}")))
            .select("r.*", F.when(F.col("node") > F.col("first"), F.col("node") - 1).alias("parent")))


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and trained text as the formatted output has them: adds ``turns``
    (array of role, text) and ``trained`` (all text under the loss mask)."""
    inner = F.transform(
        F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda p, i: i > 0),
        lambda p: F.substring_index(p, END, 1))
    return (chats
            .withColumn("turns", F.transform(inner, lambda p: F.struct(
                unescape(F.substring_index(p, "\n", 1), role=True).alias("role"),
                unescape(p.substr(F.locate("\n", p) + 1, F.length(p))).alias("text"))))
            .withColumn("trained", F.array_join(F.transform("loss", lambda s: unescape(
                F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")))
