"""Reply trees to conversations: paths by iterative self-joins, ranked by score, in a reversible template."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import map_rows
from stallbook.sources.shared import pinned

# What opens and closes a turn. Any other role is spelled out: [ROLE]name[SAYS]text[/ROLE].
TURNS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
TRAINED = "assistant"
_CONTROL = re.compile(r"([<\[])(?=(?:/?s>|</?SYS>>|/?INST\]|/?ROLE\]|SAYS\]))")
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>"
                   r"|\[ROLE\](?P<role>.*?)\[SAYS\](?P<text>.*?)\[/ROLE\]", re.DOTALL)


def escaped(text: str) -> str:
    """Backslashes are doubled, and one goes into every control string: none is left in the text."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def formatted(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """One conversation and the spans, in code points, that training takes the loss on."""
    parts, spans, position = [], [], 0
    for role, text in turns:
        body = escaped(text or "")
        opens, closes = TURNS.get(role) or (f"[ROLE]{escaped(role or '')}[SAYS]", "[/ROLE]")
        if role == TRAINED:
            spans.append((position + len(opens), position + len(opens) + len(body)))
        parts += [opens, body, closes]
        position += len(opens) + len(body) + len(closes)
    return "".join(parts), spans


def parsed(conversation: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, position = [], 0
    while position < len(conversation):
        found = _TURN.match(conversation, position)
        if not found:
            raise ValueError(f"no turn begins at {position}")
        if found["role"] is not None:
            turns.append((unescaped(found["role"]), unescaped(found["text"])))
        else:
            turns.append((found.lastgroup, unescaped(found[found.lastgroup])))
        position = found.end()
    return turns


def as_trees(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Straight conversations as reply trees: each turn answers the one before it.

    Turns are ordered by their number, then role and text, nulls first; repeated rows are turns of their own.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.col(conversation).alias("tree"), F.col(turn).alias("turn"), "role", "text")
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    return rows.select("tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"),
                       "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, per_tree: int | None = None) -> DataFrame:
    """Root-to-leaf paths of reply trees, best first: (tree, leaf, rank, position, message).

    ``messages`` has tree, message, parent and score; a message is unique in its tree. A message whose parent is
    null or not in the tree is a root. Null scores count as zero. A path's score is the sum of its messages';
    equal ones are ranked by the leaf's id. ``per_tree`` keeps that many paths of each tree, all if it is None.
    Messages that answer each other in a circle have no root and so no path. Null trees are one tree.

    Each round joins the table to itself and doubles how far up every message looks, so a path of n messages takes
    about log2(n) rounds; every round is written down. The same jumps, taken in turn from a leaf, then list all
    messages of its path, each once.
    """
    tree = F.struct("tree").alias("tree")        # a struct equals another with a null in the same place
    nodes = pinned(messages.select(tree, "message", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = nodes.select("tree", F.col("message").alias("parent"), F.lit(True).alias("there"))
    reach = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "message", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("length"),
        F.col("score").alias("total"))
    reach = pinned(reach)
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps = [reach.select("tree", "message", "up")]
    for _ in range(most.bit_length()):
        if reach.where("up is not null").isEmpty():
            break
        above = reach.select("tree", F.col("message").alias("up"), F.col("up").alias("next"),
                             F.col("length").alias("more"), F.col("total").alias("sum"))
        reach = pinned(reach.join(above, ["tree", "up"], "left").select(
            "tree", "message", F.col("next").alias("up"),
            (F.col("length") + F.coalesce("more", F.lit(0))).alias("length"),
            (F.col("total") + F.coalesce("sum", F.lit(0.0))).alias("total")))
        jumps.append(reach.select("tree", "message", "up"))

    answered = jumps[0].where("up is not null").select("tree", F.col("up").alias("message"))
    leaves = reach.where("up is null").join(answered, ["tree", "message"], "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.desc("total"), "message")
    leaves = leaves.withColumn("rank", F.row_number().over(rank))
    if per_tree is not None:
        leaves = leaves.where(F.col("rank") <= per_tree)
    paths = leaves.select("tree", F.col("message").alias("leaf"), "rank", F.col("length").alias("position"), "message")
    for k, jump in enumerate(jumps):
        up = paths.join(jump.where("up is not null"), ["tree", "message"]).select(
            "tree", "leaf", "rank", (F.col("position") - 2 ** k).alias("position"), F.col("up").alias("message"))
        paths = pinned(paths.unionAll(up))
    return paths


def format_trees(messages: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, conversation, loss_spans): one formatted conversation for each chosen path.

    See ``branches`` for the trees. Null text and null roles count as empty; an empty table gives an empty result.
    ``loss_spans`` are (start, end) code points of the assistant's words in ``conversation``.
    """
    kind = messages.schema["tree"].dataType.simpleString()
    leaf = messages.schema["message"].dataType.simpleString()
    paths = branches(messages, per_tree)
    words = messages.select(F.struct("tree").alias("tree"), "message", "role", "text")
    whole = paths.join(words, ["tree", "message"]).groupBy("tree", "leaf", "rank").agg(
        F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("turns"))

    def rows(trees: list, leaves: list, ranks: list, paths: list) -> Iterator[tuple]:
        for tree, leaf, rank, turns in zip(trees, leaves, ranks, paths):
            text, spans = formatted([(turn["role"], turn["text"]) for turn in turns])
            yield tree, leaf, rank, text, [{"start": a, "stop": b} for a, b in spans]

    return map_rows(whole.select("tree.tree", "leaf", "rank", "turns"),
                    f"tree {kind}, leaf {leaf}, rank int, conversation string, "
                    "loss_spans array<struct<start:long,stop:long>>", rows)
