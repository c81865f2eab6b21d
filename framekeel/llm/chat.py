"""Conversations from reply trees: paths from root to leaf, ranked by score, each written as one training text.

Paths are found by self-joins on ids and scores alone. In each round every message's pointer jumps to where its
target's pointer points, so a thread of a million replies takes twenty rounds. A branch's score is the sum along
its path; the best ``branches`` leaves of a tree are kept. A second sweep goes back through the rounds from the
chosen leaves and doubles their known ancestors each time, so only the chosen paths are ever spelled out.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. A text's backslashes are doubled and its
``<|`` becomes ``<\\|``, so no text can hold a control string, and reading back undoes it. The output keeps the
turns as segments with a loss flag, set for the texts of ``assistant`` only; joined, they are the formatted text.

A null text is empty, a null role too. Messages whose parent is missing or null are roots; messages on a cycle
have no root and are left out. Ties in score go by the leaf's order. Repeated rows are messages of their own. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """Roles stay on one line."""
    escaped = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return F.replace(escaped, F.lit("<|"), F.lit("<%7C"))


def unescape_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("<%7C"), F.lit("<|")), F.lit("%0A"), F.lit("\n"))
    return F.replace(plain, F.lit("%25"), F.lit("%"))


def branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """The chosen paths of each tree: ``tree``, ``leaf``, ``rank``, and per message on it ``node`` and ``depth``.

    ``messages`` has a unique ``node``, its ``parent`` in the same ``tree``, a ``score``, and ``place``, which
    orders leaves of one score.
    """
    nodes = messages.select("tree", "node", "parent", "place", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"))
    own = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("parent") == F.col("_node"))
    # `up` is the ancestor `steps` above, null if the root is nearer; `total` sums the scores passed, own included.
    jumps = nodes.join(known, own, "left").select(
        "tree", "node", "place", F.col("_node").alias("up"), F.lit(1).cast("bigint").alias("depth"), F.col("score").alias("total")
    )
    state = staged(jumps, "jumps")
    finished, active, rounds = state.where("up IS NULL"), state.where("up IS NOT NULL"), []
    while not active.isEmpty():
        rounds.append(active)
        target = active.unionByName(finished).select(
            F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("total").alias("_total")
        )
        jumped = active.join(target, "up").select(
            "tree",
            "node",
            "place",
            F.col("_up").alias("up"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("total") + F.col("_total")).alias("total"),
        )
        state = staged(jumped, "jumps")
        arrived, active = state.where("up IS NULL"), state.where("up IS NOT NULL")
        if arrived.isEmpty():
            break  # only messages on or below a cycle are left
        finished = finished.unionByName(arrived)
    rooted = finished.select("tree", "node", "place", "depth", "total")
    parents = nodes.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = rooted.join(parents, "node", "left_anti")
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "place", "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    chosen = staged(leaves.select("tree", F.col("node").alias("leaf"), "rank", "depth", "node"), "leaves")
    for pointers in reversed(rounds):
        step = pointers.select("node", "up", F.col("depth").alias("steps"))
        above = chosen.join(step, "node").select(
            "tree", "leaf", "rank", (F.col("depth") - F.col("steps")).alias("depth"), F.col("up").alias("node")
        )
        chosen = staged(chosen.unionByName(above), "paths")
    return chosen


def formatted(turns: DataFrame, *keys: str) -> DataFrame:
    """One row per ``keys`` with ``segments`` (text, loss) in order; ``turns`` has ``depth``, ``role`` and ``text``."""
    row = F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # One conversation is one training text, so its turns meet in one row.
    told = turns.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("turns"))

    def parts(turn: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), (turn["role"] == LEARNED).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )

    return told.select(*keys, F.flatten(F.transform("turns", parts)).alias("segments"))


def joined(segments: Column) -> Column:
    """The formatted text."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, r"<\|im_start\|>", -1)
    return F.transform(F.filter(pieces, lambda p: p != ""), turn)


def thread_messages(conversations: DataFrame) -> DataFrame:
    """Rows of ``conv_id``, ``turn``, ``role`` and ``text`` as messages that reply to the turn before them.

    Rows of one turn go by role and text. Longer texts score higher, a stand-in where messages carry no score.
    """
    rows = staged(
        conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.monotonically_increasing_id()),
        "messages",
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "node")
    links = rows.select(
        "*",
        F.lag("node").over(order).alias("parent"),
        F.row_number().over(order).cast("bigint").alias("place"),
        F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"),
    )
    return staged(links.withColumnRenamed("conv_id", "tree"), "threads")


def conversations_formatted(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree``, ``leaf``, ``rank`` and ``segments`` of each chosen branch."""
    paths = branches(messages, best).select("tree", "leaf", "rank", "depth", "node")
    turns = paths.join(messages.select("node", "role", "text"), "node")
    return formatted(turns, "tree", "leaf", "rank")
