"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickwork.llm.common import Stage


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of them."""
    tied = edges.join(_least(edges), "a")
    ends = F.explode(F.array("a", "b")).alias("a")
    return tied.select(ends, F.col("m").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node."""
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stage, before = Stage(edges.filter("a <> b").select(high, low).distinct(), "edges"), None
    while True:
        mark = stage.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before, last = mark, stage
        large = Stage(_large(last.df), "edges")
        stage = Stage(_small(large.df), "edges")
        last.drop()
        large.drop()
    roots = stage.df.select(F.col("b").alias("node")).distinct()
    return stage.df.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
