"""De-duplication, latest-row, shared-value and counting operators.

Hot keys: every per-key operator here is an aggregate with map-side partial
aggregation (``min_by``, ``count``) instead of a window over the key, so a
key holding a third of all rows is pre-combined in every input partition
and never sorted inside a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import SMALL, cut_lineage, written


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (NULLs compare equal).

    Only rows whose 64-bit hash occurs more than once can be equal.  The rows are written once with their hash, as
    columns; the hashes alone are shuffled, most rows pass through, and the few that are left are compared whole.  With too
    many repeated hashes to send to every executor, all rows are compared in one aggregate."""
    rows = written(df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    again = cut_lineage(rows.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__h"))
    if again.count() > SMALL:
        return rows.drop("__h").distinct()
    again = F.broadcast(again)
    once = rows.join(again, "__h", "left_anti").drop("__h")
    return once.unionByName(rows.join(again, "__h", "left_semi").drop("__h").distinct())


def latest_per_key(
    df: DataFrame,
    key: str,
    order_by: str,
    tiebreak: Sequence[str] = (),
    date_order: bool = True,
) -> DataFrame:
    """Keep one row per ``key``: the greatest ``order_by`` (NULLs last), ties
    broken by ``tiebreak`` ascending.  Rows with a NULL key are kept as one
    group, like pandas.

    Implemented as ``min_by(row, ordering)``.  Rows are not fixed in width, so
    Spark plans a sort aggregate; it is partial before the shuffle, so a hot
    key sends one row a task.
    """
    cols = df.columns
    ordv = F.col(order_by)
    if date_order:
        ordv = F.unix_date(ordv.cast("date"))
    ordering = F.struct(
        F.col(order_by).isNull().alias("n0"),
        (-ordv).alias("v0"),
        *[F.col(t).alias(f"t{i}") for i, t in enumerate(tiebreak)],
    )
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    out = df.groupBy(F.col(f"`{key}`").alias("__k")).agg(F.min_by(row, ordering).alias("__r"))
    return out.select("__r.*")


def latest_per_key_window(df: DataFrame, key: str, order_by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Window form of ``latest_per_key`` (plans as WindowGroupLimit); kept for
    comparison and for callers that need a rank column."""
    w = Window.partitionBy(key).orderBy(F.col(order_by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def shared_value_flag(df: DataFrame, key: str, flag: str) -> DataFrame:
    """``flag`` is true when another row has the same ``key`` (NULLs equal).

    Counts per key are aggregated (partial aggregation absorbs hot keys and
    the NULL group) and joined back null-safely; AQE splits a skewed join
    partition on the row side.
    """
    counts = df.groupBy(F.col(f"`{key}`").alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    j = df.join(counts, df[f"`{key}`"].eqNullSafe(counts["__k"]), "left")
    return j.withColumn(flag, F.col("__n") > 1).drop("__k", "__n")


def duplicated_key_count(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key already occurred (pandas ``duplicated().sum()``; NULL is
    one value)."""
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(F.col(key)) - F.max(F.col(key).isNull().cast("int")).cast("long"))
        .cast("long")
        .alias("duplicated")
    ).select(F.coalesce("duplicated", F.lit(0).cast("long")).alias("duplicated"))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Frequency table; NULL values are dropped (pandas default)."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def null_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: number of NULLs per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def shape(df: DataFrame) -> DataFrame:
    """One row: (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def duplicated_rows(df: DataFrame, key: str, tiebreak: Sequence[str]) -> DataFrame:
    """Rows whose key occurred on an earlier row (first occurrence by
    ``tiebreak`` is not returned)."""
    w = Window.partitionBy(key).orderBy(*[F.col(t).asc_nulls_last() for t in tiebreak])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn > 1").drop("__rn")


def top_k_per_key(df: DataFrame, key: str, score: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` rows per key by ``score`` desc, ties by ``tiebreak`` asc."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Deterministic first ``n`` rows."""
    return df.orderBy(*order).limit(n)
