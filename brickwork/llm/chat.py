"""Chat formatting of reply trees with DataFrame operations only.

A reply tree is a table of nodes (tree, node, parent, role, text, score).  Iterative
self-joins double each node's ancestor pointer, so a tree of depth d needs log2(d) joins;
the pointer tables of all levels are kept.  A branch (root-to-leaf path) is ranked within its
tree by the sum of its nodes' scores.  The nodes of the chosen branches are then listed by
cutting each path in halves, from the longest pointers to the shortest: again one join a level.
Each chosen branch becomes one conversation in a template that marks turns.

Defined cases: a NULL text, role or score counts as '' or 0; a NULL or unknown parent makes a root;
exact or conflicting repeats of a node id keep the smallest row; ties between branches go to the
longer, then to the smaller leaf; a NULL tree id is a tree of its own; a cycle raises ValueError.
A conversation ends up in one row, so a single branch must fit in a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickwork.llm.common import Stage

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """One more backslash in every ``<`` backslashes ``|``: no control string is left, and it can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def thread_nodes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as trees: each row replies to the row before it (by turn, role, text)."""
    order = Window.partitionBy("tree").orderBy("_turn", "role", "text")
    rows = turns.select(
        F.col(conv).alias("tree"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _lift(nodes: DataFrame) -> list[Stage]:
    """Pointer tables: level k holds each node's 2^k-th ancestor, the nodes passed and their score."""
    first = nodes.select("tree", "node", F.col("parent").alias("ptr"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"))
    levels, before = [Stage(first, "chat-ptr")], -1
    while (pending := levels[-1].df.filter("ptr IS NOT NULL").count()) > 0:
        if pending == before:
            raise ValueError(f"{pending} nodes lie on or under a cycle of replies")
        before = pending
        table = levels[-1].df
        up = table.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("ptr").alias("_p"), F.col("steps").alias("_s"), F.col("total").alias("_w"))
        moved = (
            table.filter("ptr IS NOT NULL")
            .join(up, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("ptr") == F.col("_n")), "left")
            .select("tree", "node", F.col("_p").alias("ptr"), (F.col("steps") + F.coalesce("_s", F.lit(0))).alias("steps"), (F.col("total") + F.coalesce("_w", F.lit(0.0))).alias("total"))
        )
        levels.append(Stage(table.filter("ptr IS NULL").unionByName(moved), "chat-ptr"))
    return levels


def _paths(chosen: DataFrame, levels: list[Stage]) -> DataFrame:
    """Rows (tree, leaf, rank, back, node) of the chosen branches; ``back`` counts from the leaf."""
    cuts = chosen.select("tree", "leaf", "rank", F.col("leaf").alias("node"), F.col("steps").alias("n"), F.lit(0).cast("long").alias("back"))
    for k in range(len(levels) - 2, -1, -1):
        half = 1 << k
        up = levels[k].df.filter("ptr IS NOT NULL").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("ptr").alias("_p"))
        long = F.when(F.col("n") > half, F.col("node"))
        near = F.struct(F.col("node").alias("node"), F.least("n", F.lit(half)).cast("long").alias("n"), F.col("back").alias("back"))
        rest = F.struct(F.col("_p").alias("node"), (F.col("n") - half).alias("n"), (F.col("back") + half).alias("back"))
        cuts = (
            cuts.join(up, F.col("tree").eqNullSafe(F.col("_t")) & (long == F.col("_n")), "left")
            .select("tree", "leaf", "rank", F.explode(F.when(F.col("n") > half, F.array(near, rest)).otherwise(F.array(near))).alias("c"))
            .select("tree", "leaf", "rank", "c.node", "c.n", "c.back")
        )
    return cuts.select("tree", "leaf", "rank", "node", "back")


def format_trees(nodes: DataFrame, top: int = 1, loss_role: str = "assistant") -> DataFrame:
    """The ``top`` branches of each tree, one conversation each: (tree, leaf, rank, n_turns, formatted,
    turn_spans).  ``turn_spans`` has, turn by turn, the code-point span of the (escaped) text in
    ``formatted`` and whether it is under the loss mask."""
    blank = nodes.select(
        "tree", "node", "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    rows = Stage(blank, "chat-nodes").df
    unique = rows.groupBy("tree", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("r")).select("tree", "node", "r.*")
    levels = _lift(unique.select("tree", "node", "parent", "score"))
    replied = levels[0].df.filter("ptr IS NOT NULL").select(F.col("tree").alias("_t"), F.col("ptr").alias("_p")).distinct()
    leaves = levels[-1].df.join(replied, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_p")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("steps"), "leaf"))
    chosen = leaves.select("tree", F.col("node").alias("leaf"), "steps", "total").withColumn("rank", rank).filter(F.col("rank") <= top)
    texts = unique.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "role", "text")
    listed = _paths(chosen, levels).join(texts, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")))

    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    line = listed.select("tree", "leaf", "rank", "back", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == loss_role).alias("loss"))
    line = line.withColumn("turn", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("tree", "leaf", "rank").orderBy(F.desc("back"))
    start = F.sum(F.length("turn")).over(order) - F.length("turn") + F.length("head")
    line = line.select("tree", "leaf", "rank", "back", "turn", "loss", start.alias("start"), (start + F.length("body")).alias("end"))
    packed = F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), "turn", "start", "end", "loss")))
    return (
        line.groupBy("tree", "leaf", "rank")
        .agg(packed.alias("t"))
        .select(
            "tree", "leaf", "rank",
            F.size("t").cast("long").alias("n_turns"),
            F.array_join("t.turn", "").alias("formatted"),
            F.transform("t", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["loss"].alias("loss"))).alias("turn_spans"),
        )
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Turns parsed from the formatted text alone, the masked text by its spans: (tree, leaf, rank, at, role,
    text, loss_text, chars); ``chars`` is the length of the formatted turn, its marker included."""
    parts = F.split("formatted", r"<\|im_start\|>", -1)
    turns = conversations.select(
        "tree", "leaf", "rank", F.posexplode(F.arrays_zip(F.slice(parts, F.lit(2), F.size(parts)).alias("part"), F.col("turn_spans").alias("span"))).alias("at", "z")
    ).select("tree", "leaf", "rank", "at", "z.part", "z.span")
    name = F.substring_index("part", "\n", 1)
    skip = F.length(name) + 1
    order = Window.partitionBy("tree", "leaf", "rank").orderBy("at")
    origin = F.sum(F.length("part") + len(START)).over(order) - F.length("part")
    begin = (F.col("span.start") - origin + 1).cast("int")
    masked = F.substring("part", begin, (F.col("span.end") - F.col("span.start")).cast("int"))
    return turns.select(
        "tree", "leaf", "rank", "at",
        F.url_decode(name).alias("role"),
        unescape(F.substring("part", skip + 1, F.length("part") - skip - len(END) - 1)).alias("text"),
        F.when(F.col("span.loss"), unescape(masked)).alias("loss_text"),
        (F.length("part") + len(START)).cast("long").alias("chars"),
    )
