"""Chat formatting of reply trees. Column functions only.

Messages point to the message they answer. Root-to-leaf paths are enumerated by joining the
table of ancestors with itself, so that each round doubles the distance covered; a
conversation of a thousand turns takes ten rounds. Paths are ranked by score, and each
chosen path becomes one text with the spans on which a model is to be trained.

A turn is ``<|im_start|>role``, a line feed, the text and ``<|im_end|>`` with a line feed. In
texts, ``<`` and ``|`` with any number of backslashes between them get one more: no control
string can arise, and taking one away restores the text. In roles, a backslash is also
written ``\\-`` and a line feed ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.llm.common import shared_table

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
MAX_ROUNDS = 40


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("\\"), F.lit("\\-")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = unescape_text(role)
    return F.replace(F.replace(plain, F.lit("\\n"), F.lit("\n")), F.lit("\\-"), F.lit("\\"))


def root_to_leaf(messages: DataFrame) -> DataFrame:
    """``(conv_id, leaf, node, distance)``: for every leaf the nodes up to its root.

    A parent that does not exist makes its child a root. Nodes without a leaf below them (a
    pure cycle) are on no path; a leaf that leads into a cycle is an error. ``conv_id`` may be
    null; a null node has neither answers nor a place in a path.
    """
    nodes = messages.select("conv_id", "node", "parent").filter("node is not null")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    nodes = nodes.select(F.struct(key.alias("c"), F.col("conv_id").isNull().alias("none")).alias("tree"), "node", "parent").distinct()
    nodes = shared_table(nodes, "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"))
    jump = shared_table(
        nodes.filter("parent is not null").join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("above")),
        "parents",
    )
    inner = jump.select("tree", F.col("above").alias("node")).distinct()
    leaves = nodes.select("tree", "node").distinct().join(inner, ["tree", "node"], "left_anti")
    paths = shared_table(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("distance")), "leaves")
    reach = 1
    for _ in range(MAX_ROUNDS):
        if jump.isEmpty():
            break
        farther = paths.join(jump, ["tree", "node"]).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("distance") + reach).alias("distance")
        )
        paths = shared_table(paths.unionByName(farther), "paths")
        if farther.isEmpty():
            break
        again = jump.select("tree", F.col("node").alias("below"), F.col("above").alias("node"))
        jump = shared_table(again.join(jump, ["tree", "node"]).select("tree", F.col("below").alias("node"), "above"), "jumps")
        reach *= 2
        if reach > 1 << 24:
            raise ValueError("a reply leads into a cycle")
    return paths


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``(conv_id, leaf, rank, score, formatted, loss_spans)``, a row per chosen path.

    ``messages(conv_id, node, parent, role, text, score)``: nodes are unique within a tree. A
    path's score is the mean of its messages' scores, null counting as 0; equal scores are
    ranked by leaf. The ``branches`` best of each tree are formatted. Null roles and texts count
    as empty. ``loss_spans`` are ``(start, length)`` in code points of the trained role's
    escaped texts. An empty table gives an empty table.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    opening = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    turns = messages.select(
        F.struct(key.alias("c"), F.col("conv_id").isNull().alias("none")).alias("tree"),
        "conv_id",
        "node",
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        opening.alias("opening"),
        escape_text(text).alias("body"),
        (role == TRAINED_ROLE).alias("trained"),
    )
    paths = root_to_leaf(messages)
    scored = paths.join(turns.select("tree", "node", "score"), ["tree", "node"])
    ranked = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    placed = paths.join(shared_table(chosen, "chosen_paths"), ["tree", "leaf"]).join(turns.drop("score"), ["tree", "node"])
    path = Window.partitionBy("tree", "leaf").orderBy(F.desc("distance"))
    size = F.length("opening") + F.length("body") + len(END)
    before = F.coalesce(F.sum(size).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turn = F.struct(
        (-F.col("distance")).alias("order"),
        F.concat("opening", "body", F.lit(END)).alias("turn"),
        "trained",
        F.struct((F.col("before") + F.length("opening")).alias("start"), F.length("body").cast("long").alias("length")).alias("span"),
    )
    gathered = (
        placed.withColumn("before", before)
        .groupBy("tree", "leaf", "rank", "score")
        .agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    return gathered.select(
        "conv_id",
        "leaf",
        "rank",
        "score",
        F.array_join(F.transform("turns", lambda t: t.turn), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t.trained), lambda t: t.span).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` as formatted."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def read(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape_text(body).alias("text"))

    return F.transform(parts, read)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    pieces = F.transform(spans, lambda s: unescape_text(F.substr(formatted, (s.start + 1).cast("int"), s.length.cast("int"))))
    return F.array_join(pieces, "")


def linear_messages(turns: DataFrame) -> DataFrame:
    """Messages of ``turns(conv_id, turn, role, text)`` where each row answers the one before
    it; rows of the same turn follow by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return placed.select(
        "conv_id",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
