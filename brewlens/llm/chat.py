"""Chat formatting from reply trees: DataFrame functions only.

A tree's nodes point to their parents.  Root-to-leaf paths are enumerated by
iterative self-joins that double their reach: after k rounds every node knows
its ancestor 2**k steps up, the sum of scores on the way and its depth, so a
path of n turns takes log2(n) rounds.  The branches of a tree are ranked by
their mean score, the best are chosen, and only the chosen leaves are walked
back to the root (again by doubling), so rows are made for chosen paths alone.
Each chosen path becomes one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside roles
and texts every ``<|`` is written ``<||``, which no control string contains,
so texts cannot forge a turn and the escape is undone by the reverse
replacement.  Line breaks and backslashes in a role are written ``\\n`` and
``\\\\``.  The loss mask is a list of (start, length) spans in UTF-8 bytes, one
for each assistant text as written.

Defined cases: null text or role is empty; a parent that does not exist makes
its node a root; equal scores rank by leaf id; an empty table gives no rows;
other columns are ignored.  Node ids must be unique and not null, and links
must not form a ring (nodes on a ring reach no root and are left out).  One
path is one output row: that is what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brewlens.llm.common import written

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def _escape(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("<||"))


def _unescape(c: Column) -> Column:
    return F.replace(c, F.lit("<||"), F.lit("<|"))


def _escape_role(c: Column) -> Column:
    return F.replace(F.replace(_escape(c), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    # between escaped backslashes, taken from the left, a backslash can only begin an escaped line break
    parts = F.transform(F.split(c, r"\\\\", -1), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    return _unescape(F.array_join(parts, "\\"))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables and reach.

    The k-th jump table has node_id and up, the ancestor 2**k steps up, for
    the nodes that lie so deep.  Reach has node_id, n (nodes up to the root,
    the node included) and total (their scores).  A round only carries nodes
    that have not reached their root.
    """
    known = nodes.select(F.col("node_id").alias("known_id"))
    first = (nodes.join(known, nodes["parent_id"] == known["known_id"], "left")
             .select("node_id", F.col("known_id").alias("up"), F.lit(1).cast("long").alias("n"),
                     F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total")))
    first = written(first, "chat-jump")
    done, going = [first.filter("up IS NULL").drop("up")], first.filter("up IS NOT NULL")
    jumps, steps, n_nodes = [], 1, first.count()
    while steps < n_nodes and going.limit(1).count():
        jumps.append(going.select("node_id", "up"))
        far = going
        for part in done:
            far = far.unionByName(part.withColumn("up", F.lit(None).cast(first.schema["up"].dataType)))
        far = far.select(F.col("node_id").alias("mid"), F.col("up").alias("far"), F.col("n").alias("far_n"),
                         F.col("total").alias("far_total"))
        step = written(going.join(far, going["up"] == far["mid"])
                       .select("node_id", F.col("far").alias("up"), (F.col("n") + F.col("far_n")).alias("n"),
                               (F.col("total") + F.col("far_total")).alias("total")), "chat-jump")
        done.append(step.filter("up IS NULL").drop("up"))
        going, steps = step.filter("up IS NOT NULL"), 2 * steps
    reach = done[0]
    for part in done[1:]:
        reach = reach.unionByName(part)
    return jumps, reach


def chosen_leaves(nodes: DataFrame, reach: DataFrame, top: int | None) -> DataFrame:
    """leaf_id, tree_id, n_turns, branch_score, branch_rank of the best ``top`` branches of each tree (None: all)."""
    parents = nodes.filter("parent_id IS NOT NULL").select(F.col("parent_id").alias("inner_id")).distinct()
    leaves = (nodes.select("tree_id", F.col("node_id").alias("leaf_id"))
              .join(parents, F.col("leaf_id") == F.col("inner_id"), "left_anti"))
    branches = (leaves.join(reach, leaves["leaf_id"] == reach["node_id"])
                .select("tree_id", "leaf_id", F.col("n").alias("n_turns"), (F.col("total") / F.col("n")).alias("branch_score")))
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("branch_score"), "leaf_id"))
    ranked = branches.withColumn("branch_rank", rank)
    return ranked if top is None else ranked.filter(F.col("branch_rank") <= top)


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """leaf_id, node_id, place (steps above the leaf) of every turn of the chosen paths.

    A row (leaf, node, place) at level k stands for the 2**k nodes from node
    upwards; the self-join with the jumps of 2**(k-1) splits it in two halves.
    """
    rows = chosen.select("leaf_id", F.col("leaf_id").alias("node_id"), F.lit(0).cast("long").alias("place"))
    for k in range(len(jumps) - 1, -1, -1):
        jump = jumps[k].select(F.col("node_id").alias("at"), "up")
        upper = (rows.join(jump, rows["node_id"] == jump["at"])
                 .select("leaf_id", F.col("up").alias("node_id"), (F.col("place") + (1 << k)).alias("place")))
        rows = written(rows.unionByName(upper), "chat-path")
    return rows


def format_trees(nodes: DataFrame, top: int | None = 1) -> DataFrame:
    """tree_id, leaf_id, n_turns, branch_score, branch_rank, formatted, loss_spans.

    ``nodes``: tree_id, node_id, parent_id (null at a root), score, role, text.
    ``top`` branches of each tree are formatted (None: every branch).
    """
    nodes = nodes.select("tree_id", "node_id", "parent_id", "score", "role", "text")
    jumps, reach = climb(nodes)
    chosen = written(chosen_leaves(nodes, reach, top), "chat-chosen")
    role = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    turn = nodes.select(F.col("node_id").alias("turn_id"), F.struct(
        role.alias("head"), _escape(F.col("text")).alias("body"),
        F.coalesce(F.col("role") == LEARNED_ROLE, F.lit(False)).alias("learned")).alias("turn"))
    walked = paths(chosen, jumps)
    turns = walked.join(turn, walked["node_id"] == turn["turn_id"]).select(
        "leaf_id", F.struct((-F.col("place")).alias("order"), F.col("turn.head").alias("head"),
                            F.col("turn.body").alias("body"), F.col("turn.learned").alias("learned")).alias("t"))
    whole = turns.groupBy("leaf_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    tail = F.lit(END + "\n")
    sizes = F.transform("ts", lambda t: F.struct(
        F.octet_length(t["head"]).cast("long").alias("head"), F.octet_length(t["body"]).cast("long").alias("body"),
        t["learned"].alias("learned")))
    text = F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], tail)), "")
    end = len(END) + 1
    # running byte position; a span for each learned text
    spans = F.aggregate(
        "sizes", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda a, s: F.struct(
            (a["at"] + s["head"] + s["body"] + end).alias("at"),
            F.when(s["learned"], F.concat(a["spans"], F.array(F.struct((a["at"] + s["head"]).alias("start"), s["body"].alias("length")))))
            .otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    done = whole.select("leaf_id", text.alias("formatted"), sizes.alias("sizes")).select("leaf_id", "formatted", spans.alias("loss_spans"))
    return chosen.join(done, "leaf_id").select("tree_id", "leaf_id", "n_turns", "branch_score", "branch_rank",
                                               "formatted", "loss_spans")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"\Q" + START + r"\E", -1), lambda p, i: i > 0)
    end = END + "\n"

    def parse(p):
        body = F.substring(p, F.lit(1), F.length(p) - len(end))
        cut = F.instr(body, "\n")
        return F.struct(_unescape_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        _unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    return F.transform(pieces, parse)


def read_loss(formatted_bytes: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, in order."""
    parts = F.transform(spans, lambda s: F.substring(formatted_bytes, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))
    return F.array_join(F.transform(parts, _unescape), "")


def linear(conversations: DataFrame) -> DataFrame:
    """Conversations without branches as reply trees: each row answers the row before it.

    Rows go by turn, ties by role and text; a conversation's rows are numbered
    by a sort within the conversation.
    """
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
                                              F.col("text").asc_nulls_first())
    numbered = conversations.select("conv_id", "role", "text", F.row_number().over(w).cast("long").alias("place"))
    key = lambda n: F.struct(F.col("conv_id").alias("conv_id"), n.alias("place"))
    return numbered.select(F.col("conv_id").alias("tree_id"), key(F.col("place")).alias("node_id"),
                           F.when(F.col("place") > 1, key(F.col("place") - 1)).alias("parent_id"),
                           F.lit(1.0).alias("score"), "role", "text")
