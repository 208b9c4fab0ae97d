"""Conversations from reply trees, as marked text.

Messages point at the message they answer. Iterative self-joins double the distance each message
knows its ancestors over, summing scores on the way, until every leaf knows its whole branch's score; the
best leaves of a tree are chosen, and the same jumps, from the leaf upwards, enumerate the
messages of each chosen path. Only ids and scores take part in the joins; texts join once at the end.

A turn is written as ``<|im_start|>role``, a newline, the text and ``<|im_end|>`` with a newline. In
texts a backslash goes between ``<`` and ``|`` (after backslashes that are there already), so no
text contains a mark, and removing one backslash restores it. Roles escape their newlines as well.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import written

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
_TURN_END = f"{END}\n"
# A path longer than 2^_DOUBLINGS messages is an error.
_DOUBLINGS = 40


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Also free of newlines; ``%`` is the sign of the escape."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(
        F.lit(START), escape_role(F.coalesce(role, empty)), F.lit("\n"),
        escape(F.coalesce(text, empty)), F.lit(_TURN_END),
    )


def parse_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from the marked text."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    whole = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last mark

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        role = F.substring(piece, F.lit(len(START) + 1), line - len(START) - 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substring(piece, line + 1, F.length(piece))).alias("text"),
        )

    return F.transform(whole, turn)


def loss_text(formatted: Column) -> Column:
    """The text a model is trained on: what assistants say, unescaped, in order."""
    said = F.filter(parse_turns(formatted), lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(said, lambda t: t["text"]), "")


def choose_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best root-to-leaf paths of every tree: ``tree``, ``branch`` (from 1), ``depth`` (from 0
    at the root) and ``node``.

    ``messages`` has ``tree``, ``node``, ``parent`` (NULL at a root) and ``score`` (NULL counts 0); nodes are
    unique within a tree. Branches rank by the sum of the scores along the path, ties by the smaller
    leaf; a parent that is not there makes a root. A cycle is an error.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    there = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_n"))
    # up: the ancestor 2^k levels above (NULL beyond the root); total: scores from here to below it
    jumps = written(
        nodes.join(known, there, "left").select(
            "tree", "node", F.col("_n").alias("up"), F.col("score").alias("total"),
            F.when(F.col("_n").isNotNull(), 1).otherwise(0).cast("long").alias("depth"),
        ),
        "tree-jumps",
    )
    parents = jumps.filter("up is not null").select(F.col("tree").alias("_t"), F.col("up").alias("_n")).distinct()
    leaf = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))
    leaves = jumps.join(parents, leaf, "left_anti").select("tree", "node")
    levels = [jumps]
    while not levels[-1].filter("up is not null").isEmpty():
        if len(levels) > _DOUBLINGS:
            raise ValueError("a reply tree has a cycle")
        levels.append(written(_doubled(levels[-1]), "tree-jumps"))
    # the last level has summed every path up to its root
    scored = leaves.withColumnsRenamed({"tree": "_t", "node": "_n"}).join(levels[-1], leaf)
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    chosen = (
        scored.withColumn("branch", F.row_number().over(best))
        .filter(F.col("branch") <= branches)
        .select("tree", "branch", "node", "depth")
    )
    path = written(chosen, "tree-path")
    # jumps of falling length reach every ancestor of the leaf once
    for level in reversed(levels[:-1]):
        step = level.filter("up is not null").select(
            F.col("tree").alias("_t"), F.col("node").alias("_n"), "up"
        )
        at = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))
        higher = path.join(step, at).select(
            "tree", "branch", F.col("up").alias("node"), (F.col("depth") - _length(levels, level)).alias("depth")
        )
        path = written(path.unionByName(higher), "tree-path")
    return path


def _length(levels: list[DataFrame], level: DataFrame) -> int:
    return 1 << next(i for i, other in enumerate(levels) if other is level)


def _doubled(jumps: DataFrame) -> DataFrame:
    """Jumps twice as long; messages whose jump has passed the root take no part in the join."""
    above = jumps.select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"),
        F.col("total").alias("_total"), F.col("depth").alias("_depth"),
    )
    at = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_n"))
    longer = jumps.filter("up is not null").join(above, at).select(
        "tree", "node", F.col("_up").alias("up"),
        (F.col("total") + F.col("_total")).alias("total"),
        (F.col("depth") + F.col("_depth")).alias("depth"),
    )
    return longer.unionByName(jumps.filter("up is null"))


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: ``tree``, ``branch``, ``formatted``.

    ``messages`` as in :func:`choose_paths` plus ``role`` and ``text`` (NULL: empty). A tree of one message
    is a path of one turn; no messages give no rows. The text of a conversation is one value, so one
    conversation has to fit in a task.
    """
    path = choose_paths(messages, branches)
    said = messages.select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), format_turn(F.col("role"), F.col("text")).alias("turn")
    )
    at = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))
    turns = F.array_sort(F.collect_list(F.struct("depth", "turn")))
    return (
        path.join(said, at)
        .groupBy("tree", "branch")
        .agg(F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("formatted"))
    )


def linear_replies(conversations: DataFrame) -> DataFrame:
    """Messages of plain conversations (``conv_id``, ``turn``, ``role``, ``text``): each answers the one before.

    Rows of one turn follow each other by role and text; rows repeated in full are turns of their own.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    place = F.row_number().over(order).cast("long")
    return conversations.select("conv_id", "role", "text", place.alias("node")).select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(1.0).alias("score"),
        "role",
        "text",
    )


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """What the marked texts say, read back from them."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    said = F.filter("turns", lambda t: t["role"] == "assistant")
    loss = F.array_join(F.transform(said, lambda t: t["text"]), "")
    parsed = formatted.withColumn("turns", parse_turns(F.col("formatted")))
    return parsed.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
