"""Chat formatting of reply trees, DataFrame functions only.

Messages form trees through ``parent_id``.  Ancestor pointers are doubled by iterative
self-joins (log2 of the depth rounds), which gives every message its depth and the score
sum of its path; leaves are branches, ranked by that score; the chosen branches expand
back to their root-to-leaf paths along the same pointer tables, and each path becomes one
conversation string.

Template per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts every ``<``,
backslashes, ``|`` gets one more backslash, so no control string can appear and the text
can be restored; roles also write ``%`` and line feeds as %25 and %0A.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usagelens.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """Text without any control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    """The text that :func:`escape` was given."""
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def key_text(c) -> Column:
    """An id as a join key that also holds for null ids."""
    return F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))


def pointer_tables(nodes: DataFrame) -> list[DataFrame]:
    """Tables k = 0, 1, ...: ancestor 2^k steps up, with score sum and length of those steps.

    ``nodes``: tree, id, up, total, steps.  Ends when no message has an ancestor left; a
    parent cycle never does, so the rounds are bounded by the size of the largest tree.
    """
    table = materialize(nodes, "reply-pointers")
    tables = [table]
    largest = table.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    while (1 << len(tables)) <= 2 * largest and not table.where("up is not null").isEmpty():
        above = table.select("tree", F.col("id").alias("up"), F.col("up").alias("up2"),
                             F.col("total").alias("total2"), F.col("steps").alias("steps2"))
        climbing = (table.where("up is not null").join(above, ["tree", "up"], "left")
                    .select("tree", "id", F.col("up2").alias("up"),
                            (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
                            (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps")))
        table = materialize(climbing.unionByName(table.where("up is null")), "reply-pointers")
        tables.append(table)
    return tables


def format_reply_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One conversation per chosen root-to-leaf path.

    ``messages``: tree_id, message_id, parent_id, role, text, score (other columns are
    ignored).  Result: tree_id, leaf_id, branch_rank, branch_score, n_turns, formatted,
    loss_spans (array of start, length in code points: the assistants' escaped texts).

    Null texts and roles are empty, null scores 0, null tree ids one tree; a null or
    unknown parent makes a root; of rows that repeat a message id the smallest one stays;
    ties between branches go to the longer path, then the smaller leaf id.  Messages whose
    parents form a cycle have no root and give no path.  An empty table gives no rows.
    """
    raw = messages.select(
        key_text("tree_id").alias("tree"), key_text("message_id").alias("id"),
        key_text("parent_id").alias("parent"), "tree_id", "message_id",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    unique = (raw.groupBy("tree", "id").agg(F.min(F.struct(
        "parent", "role", "text", "score", "tree_id", "message_id")).alias("m"))
        .select("tree", "id", "m.*"))
    unique = materialize(unique, "reply-messages")
    known = unique.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    nodes = (unique.join(known, ["tree", "parent"], "left")
             .select("tree", "id", F.when(F.col("known") & (F.col("parent") != F.col("id")),
                                          F.col("parent")).alias("up"),
                     F.col("score").alias("total"), F.lit(1).cast("long").alias("steps")))
    tables = pointer_tables(nodes)
    rooted = tables[-1].where("up is null").drop("up")
    parents = tables[0].where("up is not null").select("tree", F.col("up").alias("id")).distinct()
    leaves = rooted.join(parents, ["tree", "id"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("steps"), "id")
    chosen = leaves.withColumn("branch_rank", F.row_number().over(best))
    if branches is not None:
        chosen = chosen.where(F.col("branch_rank") <= branches)
    paths = materialize(chosen.select("tree", F.col("id").alias("leaf"), "id", "branch_rank",
                                      F.col("total").alias("branch_score")), "reply-paths")
    for table in reversed(tables[:-1]):
        up = table.where("up is not null").select("tree", "id", "up")
        higher = paths.join(up, ["tree", "id"]).select(
            "tree", "leaf", F.col("up").alias("id"), "branch_rank", "branch_score")
        paths = materialize(paths.unionByName(higher), "reply-paths")
    turns = (paths.join(rooted.select("tree", "id", F.col("steps").alias("depth")), ["tree", "id"])
             .join(unique.select("tree", "id", "role", "text", "tree_id", "message_id"),
                   ["tree", "id"]))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    along = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, -1)
    turns = (turns.withColumn("head", head).withColumn("body", escape(F.col("text")))
             .withColumn("segment", F.concat("head", "body", F.lit(END)))
             .withColumn("before", F.coalesce(F.sum(F.char_length("segment")).over(along),
                                              F.lit(0).cast("long"))))
    span = F.struct((F.col("before") + F.char_length("head")).alias("start"),
                    F.char_length("body").cast("long").alias("length"))
    whole = turns.groupBy("tree", "leaf").agg(
        F.max(F.when(F.col("id") == F.col("leaf"), F.struct("tree_id", "message_id"))).alias("key"),
        F.first("branch_rank").alias("branch_rank"), F.first("branch_score").alias("branch_score"),
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("depth", "segment"))).alias("segments"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", span))).alias("loss_spans"))
    return whole.select(
        F.col("key.tree_id").alias("tree_id"), F.col("key.message_id").alias("leaf_id"),
        "branch_rank", "branch_score", "n_turns",
        F.array_join("segments.segment", "").alias("formatted"), "loss_spans")


def read_back(conversations: DataFrame) -> DataFrame:
    """Parses ``formatted`` and ``loss_spans`` again: adds turns (role, text) and loss_text."""
    parts = F.split("formatted", F.lit(r"<\|im_end\|>\n"))
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    head = len(START)

    def turn(p):
        line = F.instr(p, "\n")
        return F.struct(
            unescape_role(F.substring(p, F.lit(head + 1), line - head - 1)).alias("role"),
            unescape(F.substring(p, line + 1, F.char_length(p))).alias("text"))

    def masked(s):
        return unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"),
                                    s["length"].cast("int")))

    return (conversations.withColumn("turns", F.transform(parts, turn))
            .withColumn("loss_text", F.array_join(F.transform("loss_spans", masked), "")))


def chain_messages(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) as trees: each turn answers the one before.

    Turns are ordered by turn (nulls first); equal turns by role, then text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (conversations.select("conv_id", "turn", "role", "text")
            .withColumn("message_id", F.row_number().over(order))
            .select(F.col("conv_id").alias("tree_id"), "message_id",
                    (F.col("message_id") - 1).alias("parent_id"), "role", "text",
                    F.lit(0.0).alias("score")))


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Formats chains and returns the digests read back from the formatted strings."""
    got = read_back(format_reply_trees(chain_messages(conversations)))
    said = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
