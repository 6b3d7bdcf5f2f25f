"""Merkle manifest of a dataset, stored in van Emde Boas order.

Every group of rows (a source) has a tree of fan-out 16 over its leaves, which ascend by id; the groups' roots, ordered
by group, are the leaves of one more tree.  A tree is cut into aligned subtrees of ``LEVELS`` levels.  Each is a
*block*: one binary value with the 32-byte digests of its nodes, built in a task by itself.  The roots of a tree's blocks
are the leaves of its next round of blocks, so a tree of n leaves takes log(n) / log(16^3) rounds, and neither a
task nor the driver ever holds more than a block.

In a block the nodes lie in van Emde Boas order: a tree of h levels is split at half height into a top tree of
h // 2 levels, stored first, and the bottom trees that hang from it, stored one after the other, each split again.
``address`` computes a node's place from its level and number alone; construction writes and proofs read
through it, and a walk from leaf to root stays in few stretches of memory, whatever the cache's line is.

Defined cases: a NULL group is a group of its own, before all others; NULL ids come first in their group, rows that share
an id are ordered by their leaf, equal rows by their place in the written table of leaves; a group of one
row has its leaf as root; a proof without siblings is the digest of nothing; an empty table has no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickwork.llm.common import Stage, key_runs, shuffle_partitions, small_side

FAN = 16
#: Levels of a full block: leaves, 16, 256 and one node for 4,096 leaves.
LEVELS = 4
#: The tree over the groups' roots; groups are "-" (NULL) or "=" and their name, which sorts NULL first, then bytewise.
TOP = "+"


def size(levels: int, leaves):
    """Nodes of a tree with that many leaves and levels (the last node of a level may have few children or one)."""
    return sum(-(-leaves // FAN**k) for k in range(levels))


def levels_of(leaves: int) -> int:
    """Levels until one node remains."""
    n = 1
    while leaves > 1:
        leaves, n = -(-leaves // FAN), n + 1
    return n


def address(level, number, levels: int, leaves):
    """Place of a node in van Emde Boas order; ``level`` counts from the root's 0, ``number`` from the left.

    ``number`` and ``leaves`` may be arrays (of one tree each)."""
    number, leaves = np.asarray(number, np.int64), np.asarray(leaves, np.int64)
    if levels == 1:
        return np.zeros(np.broadcast(number, leaves).shape, np.int64)
    top = levels // 2
    bottom = levels - top
    held = FAN ** (bottom - 1)  # leaves of a bottom tree
    trees = -(-leaves // held)
    top_leaves = -(-trees // FAN)
    if level < top:
        return address(level, number, top, top_leaves)
    per = FAN ** (level - top)  # this level's nodes of a bottom tree
    tree = number // per
    own = np.where(tree == trees - 1, leaves - (trees - 1) * held, held)
    return size(top, top_leaves) + tree * size(bottom, held) + address(level - top, number % per, bottom, own)


class Block:
    """The nodes of an aligned subtree, by address."""

    def __init__(self, levels: int, leaves: int, nodes: bytes | None = None):
        self.levels = levels
        self.nodes = np.zeros(size(levels, leaves), "V32") if nodes is None else np.frombuffer(nodes, "V32")
        self.places = [address(k, np.arange(-(-leaves // FAN ** (levels - 1 - k))), levels, leaves) for k in range(levels)]

    @classmethod
    def build(cls, levels: int, digests: list[str]) -> Block:
        found, row = cls(levels, len(digests)), digests
        for level in range(levels - 1, -1, -1):
            if level < levels - 1:
                row = [sha256("".join(row[i : i + FAN]).encode()).hexdigest() for i in range(0, len(row), FAN)]
            found.nodes[found.places[level]] = np.frombuffer(bytes.fromhex("".join(row)), "V32")
        return found

    def level(self, level: int) -> list[str]:
        flat = self.nodes[self.places[level]].tobytes().hex()
        return [flat[i : i + 64] for i in range(0, len(flat), 64)]

    def root(self) -> str:
        return self.nodes[self.places[0][0]].tobytes().hex()

    def paths(self) -> list[list[tuple[str, str]]]:
        """Of every leaf: its siblings before and after it, level by level up to the block's root."""
        paths: list[list[tuple[str, str]]] = [[]]
        for level in range(1, self.levels):
            row = self.level(level)
            down = []
            for i in range(len(row)):
                a = i - i % FAN
                down.append([("".join(row[a:i]), "".join(row[i + 1 : a + FAN])), *paths[i // FAN]])
            paths = down
        return paths


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = sha256((before + digest + after).encode()).hexdigest()
    return digest


def field(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str], name: str) -> Stage:
    """``rows`` with ``pos``, their number (from 0) within ``tree`` in that order, and ``n``, the tree's rows.

    A total order by range partitions: a row's number is its place in its partition and the rows of the partitions
    before, so that no tree has to fit one task."""
    spark, at = rows.sparkSession, F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(2 * shuffle_partitions(spark), tree, *order).sortWithinPartitions(tree, *order)
    written = Stage(ordered.withColumn("_at", at).withColumn("_run", F.shiftright("_at", 33)), f"{name}-sorted")
    runs = written.df.groupBy(tree, "_run").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    bases = Stage(runs.select(tree, "_run", base.alias("_base"), F.sum("_rows").over(whole).alias("n")), f"{name}-bases")
    found = written.df.join(small_side(bases.df, 200_000), [tree, "_run"]).withColumn("pos", F.col("_at") + F.col("_base"))
    out = Stage(found.drop("_at", "_run", "_base"), f"{name}-numbered")
    written.drop()
    bases.drop()
    return out


_BLOCKS = "tree string, block long, n long, levels int, leaves int, root string, nodes binary"


def _build(frames: Iterator) -> Iterator:
    import pandas as pd

    for frame in key_runs(frames, ["tree", "block"]):
        out = []
        for (tree, block), rows in frame.groupby(["tree", "block"], sort=False):
            n = int(rows["n"].iloc[0])
            last = n <= FAN ** (LEVELS - 1)
            made = Block.build(levels_of(n) if last else LEVELS, rows["digest"].tolist())
            out.append((tree, block, n, made.levels, len(rows), made.root(), made.nodes.tobytes()))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _BLOCKS.split(", ")])


def blocked(leaves: DataFrame) -> DataFrame:
    return leaves.withColumn("block", F.floor(F.col("pos") / FAN ** (LEVELS - 1)).cast("long"))


def rounds_of(leaves: DataFrame, name: str) -> list[Stage]:
    """Blocks round by round, for all trees of (tree, pos, n, digest) at once."""
    found = []
    while leaves is not None:
        dealt = blocked(leaves.select("tree", "pos", "n", "digest")).repartition("tree", "block")
        made = dealt.sortWithinPartitions("tree", "block", "pos").mapInPandas(_build, _BLOCKS)
        found.append(Stage(made, f"{name}-round{len(found)}"))
        higher = found[-1].df.filter(F.col("n") > FAN ** (LEVELS - 1))
        parents = F.ceil(F.col("n") / FAN ** (LEVELS - 1)).cast("long").alias("n")
        leaves = higher.select("tree", F.col("block").alias("pos"), parents, F.col("root").alias("digest"))
        if higher.isEmpty():
            leaves = None
    return found


_PATH = "array<struct<before: string, after: string>>"
_HELD = f"tree string, pos long, path {_PATH}"


def _held(frames: Iterator) -> Iterator:
    import pandas as pd

    for frame in frames:
        for row in frame.itertuples():
            above = [(step["before"], step["after"]) for step in row.path] if row.path is not None else []
            paths = Block(row.levels, row.leaves, row.nodes).paths()
            first = row.block * FAN ** (LEVELS - 1)
            for a in range(0, len(paths), 512):
                part = [path + above for path in paths[a : a + 512]]
                listed = [[{"before": b, "after": c} for b, c in path] for path in part]
                yield pd.DataFrame({"tree": row.tree, "pos": range(first + a, first + a + len(part)), "path": listed})


def _above(rounds: list[Stage], path: DataFrame | None) -> DataFrame:
    """Blocks of the first round with the path of their root up to the whole root; ``path`` is that of a tree's root."""
    blocks = None
    for k in range(len(rounds) - 1, -1, -1):
        final = rounds[k].df.filter(F.col("n") <= FAN ** (LEVELS - 1))
        if path is None:
            final = final.withColumn("path", F.array().cast(_PATH))
        else:
            final = final.join(path, "tree")
        if blocks is not None:
            inner = blocks.mapInPandas(_held, _HELD).withColumnRenamed("pos", "block")
            final = final.unionByName(rounds[k].df.filter(F.col("n") > FAN ** (LEVELS - 1)).join(inner, ["tree", "block"]))
        blocks = final
    return blocks


class Manifest:
    """A written Merkle tree: numbered leaves, blocks of each round, and the tree over the groups' roots.

    ``leaves`` holds (tree, pos, n, id, digest) and the columns kept besides; ``rounds`` and ``tops`` hold blocks."""

    def __init__(self, leaves: Stage, rounds: list[Stage], tops: list[Stage], groups: Stage):
        self.leaves, self.rounds, self.tops, self.groups = leaves, rounds, tops, groups

    def root(self) -> str | None:
        """The root of the whole; none for an empty table."""
        row = self.tops[-1].df.filter(F.col("n") <= FAN ** (LEVELS - 1)).select("root").first()
        return row.root if row else None

    def subroots(self) -> DataFrame:
        """(tree, subroot, pos): the roots of the groups and their numbers in the tree over them."""
        return self.groups.df.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "pos")

    def proofs(self, claim: Column) -> DataFrame:
        """The leaves' columns with proof_sha256, the digest of all siblings from leaf to root, subroot, root, and
        folded_root, which the leaf digest ``claim`` gives with the stored siblings."""
        from pyspark.sql.types import StringType, StructField, StructType

        tops = _above(self.tops, None).mapInPandas(_held, _HELD).select("pos", "path")
        groups = self.subroots().join(tops, "pos").select("tree", "path")
        blocks = _above(self.rounds, Stage(groups, "merkle-tops").df).select("tree", "block", "levels", "leaves", "nodes", "path")
        leaves = blocked(self.leaves.df).withColumn("claim", claim)
        found = StructType([*leaves.schema.fields, *(StructField(c, StringType()) for c in ("proof_sha256", "folded_root"))])

        def prove(rows, block):
            import pyarrow as pa

            held = block.to_pylist()[0]
            above = [(step["before"], step["after"]) for step in held["path"]]
            paths = Block(held["levels"], held["leaves"], held["nodes"]).paths()
            proofs, roots = [], []
            for pos, digest in zip(rows["pos"].to_pylist(), rows["claim"].to_pylist(), strict=True):
                path = paths[pos % FAN ** (LEVELS - 1)] + above
                proofs.append(sha256("".join([x for step in path for x in step]).encode()).hexdigest())
                roots.append(fold(digest, path))
            return rows.append_column("proof_sha256", pa.array(proofs, pa.string())).append_column("folded_root", pa.array(roots, pa.string()))

        proved = leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(prove, found)
        subroots = small_side(Stage(self.subroots().drop("pos"), "merkle-subroots").df, 200_000)
        return proved.join(subroots, "tree").withColumn("root", F.lit(self.root()).cast("string"))


def build(docs: DataFrame, leaf: Column, id: str = "doc_id", group: str = "source", **kept: Column) -> Manifest:
    """A manifest of ``docs``; ``leaf`` is the digest of a row (hex), ``kept`` are columns to carry beside it."""
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    rows = docs.select(named.alias("tree"), F.col(id).alias("id"), leaf.alias("digest"), *[c.alias(k) for k, c in kept.items()])
    raw = Stage(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = numbered(raw.df, "tree", ["id", "digest", "row"], "merkle-leaves")
    raw.drop()
    rounds = rounds_of(leaves.df, "merkle-groups")
    roots = [r.df.filter(F.col("n") <= FAN ** (LEVELS - 1)).select(F.col("tree").alias("group"), F.col("root").alias("digest")) for r in rounds]
    above = roots[0]
    for more in roots[1:]:
        above = above.unionByName(more)
    groups = numbered(above.withColumn("tree", F.lit(TOP)), "tree", ["group"], "merkle-top")
    return Manifest(leaves, rounds, rounds_of(groups.df, "merkle-top"), groups)
