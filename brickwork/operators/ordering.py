"""Sorted outputs and row positions (O1-O3, O5) without a single-task sort.

A total order is a range partitioning by the sort columns, with each partition sorted: the files of the sink follow
one another in that order.  A row's position is its place in its partition plus the rows of the partitions
before, which is a prefix sum over as many numbers as there are partitions.

Sort columns are names (ascending, NULLs last) or Column orders such as ``F.desc_nulls_last("UPRN")``.  Rows that agree
in all of them keep no particular order; name further columns where a total order is wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def orders(by: Sequence[str | Column]) -> list[Column]:
    return [F.asc_nulls_last(c) if isinstance(c, str) else c for c in by]


def in_order(df: DataFrame, by: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` in a total order over its partitions."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *orders(by)).sortWithinPartitions(*orders(by))


def write_sorted(df: DataFrame, path: str, by: Sequence[str | Column], format: str = "parquet", partitions: int | None = None, **options) -> None:
    """A sorted table or extract: file after file, row after row."""
    in_order(df, by, partitions).write.mode("overwrite").format(format).options(**options).save(path)


def with_position(df: DataFrame, by: Sequence[str | Column], out: str = "position") -> DataFrame:
    """``df`` with the number of each row (from 1) in the order ``by``.

    The ordered rows are written once, with the place that they got, so that counts and rows come from one and the
    same partitioning, lost executors or not."""
    spark, place = df.sparkSession, F.monotonically_increasing_id()
    path = scratch_path(spark, "ordered")
    in_order(df, by).withColumn("_place", place).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_place", T.LongType())])
    written = spark.read.schema(schema).parquet(path).withColumn("_part", F.shiftright("_place", 33))
    counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()  # a number for each partition
    before, starts = 0, {}
    for part, n in sorted((r[0], r.n) for r in counts):
        starts[part] = before - (part << 33)
        before += n
    if not starts:
        return df.withColumn(out, F.lit(None).cast("long"))
    firsts = F.array(*[F.lit(starts.get(p, 0)).cast("long") for p in range(max(starts) + 1)])
    position = F.col("_place") + F.get(firsts, F.col("_part").cast("int")) + 1
    return written.withColumn(out, position).drop("_place", "_part")


def first_rows(df: DataFrame, n: int, by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in that order: each task keeps ``n``, the driver's merge is of those alone."""
    return df.orderBy(*orders(by)).limit(n)
