"""Comparison of two releases of a table (J12, D1, M11): bucket digests first, rows of unequal buckets only.

``write_snapshot`` stores a release by buckets of its key, with a digest of each bucket beside it.  ``diff_snapshots``
compares the digests, which are as many as the buckets, and reads only the buckets that differ; the others are
neither opened nor shuffled.  Rows are stored with their hashes.  Of the buckets that differ the hashes alone are read and
shuffled first; rows that both sides hold equally often by their 128 bits stay out of what is compared whole.

Rows are compared as multisets: equal rows of both sides cancel out in one aggregate.  What is left of a key is paired
in the order of the compared columns (``occurrence`` numbers the pairs), so a key that occurs many times is
compared row by row and nothing multiplies.  Rows without a key cannot be paired: they are added or removed.

Defined cases: values are equal NULL-safely and NaN equals NaN; a column of one side only is left to ``schema_diff``;
an empty side makes every row of the other one added or removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import OPEN_FILE, SMALL, cut_lineage, unsorted_writes

BUCKET = "_bucket"
#: The row's hashes, stored with it.
HASHES = ["_h1", "_h2"]


def _q(name: str):
    return F.col(f"`{name}`")


def row_hashes(cols: Sequence[str]):
    """128 bits of a row's values and of which of them are NULL."""
    bit = lambda i, c: F.shiftleft(_q(c).isNull().cast("long"), i)
    nulls = [reduce(Column.bitwiseOR, [bit(i, c) for i, c in enumerate(cols[n : n + 60])]) for n in range(0, len(cols), 60)]
    return F.xxhash64(*[_q(c) for c in cols], *nulls), F.xxhash64(F.lit(1), *nulls, *[_q(c) for c in cols])


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """A release: ``path`` by bucket, and ``path/_digests`` with a line a bucket (rows and sums of row hashes)."""
    bucket = F.pmod(F.xxhash64(*[_q(k) for k in keys]), F.lit(buckets)).cast("int")
    # column order must not matter, so hashes go by name
    placed = df.withColumns({BUCKET: bucket, **dict(zip(HASHES, row_hashes(sorted(df.columns)), strict=True))})
    # each task adds its rows to files of its own, one a bucket: they are wide, and stay where they are
    with unsorted_writes(df.sparkSession, buckets):
        placed.write.mode("overwrite").option("parquet.block.size", OPEN_FILE).partitionBy(BUCKET).parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    d1, d2 = (F.sum(F.col(h).cast("decimal(38,0)")) for h in HASHES)
    digest = stored.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), d1.alias("d1"), d2.alias("d2"))
    digest.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_digests")


def unequal_buckets(spark: SparkSession, a: str, b: str) -> list[int]:
    """Buckets whose digests differ or that one side lacks; at most as many as there are buckets."""
    kind = f"{BUCKET} int, rows long, d1 decimal(38,0), d2 decimal(38,0)"
    one, other = (spark.read.schema(kind).parquet(f"{p.rstrip('/')}/_digests") for p in (a, b))
    either = one.unionByName(other).groupBy(BUCKET, "rows", "d1", "d2").agg(F.count(F.lit(1)).alias("sides"))
    return sorted(r[0] for r in either.filter("sides = 1").select(BUCKET).distinct().collect())


def diff_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """``(*keys, occurrence, column, old, new, change)``, a line for every value that was changed, and for every
    value of an added or removed row."""
    keys = list(keys)
    cols = [c for c in (cols or a.columns) if c not in keys and c in b.columns and c not in (BUCKET, *HASHES)]
    kinds = {f.name: f.dataType for f in a.schema.fields}
    order = [*keys, *cols]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[_q(c).cast(kinds[c]).alias(c) for c in order], F.lit(sign).alias("_n"))

    left_over = side(a, 1).unionByName(side(b, -1)).groupBy(*[_q(c) for c in order]).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    copies = left_over.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_n")))).withColumn("_old", F.col("_n") > 0)
    keyed = F.lit(True)
    for k in keys:
        keyed &= _q(k).isNotNull()
    number = F.row_number().over(Window.partitionBy(*[_q(k) for k in keys], "_old").orderBy(*[_q(c).asc_nulls_first() for c in cols], "_copy"))

    def values(df: DataFrame) -> DataFrame:
        return df.select(*[_q(k) for k in keys], number.alias("occurrence"), "_old", F.struct(*[_q(c) for c in cols]).alias("_row"))

    with_key = values(copies.filter(keyed))
    old = with_key.filter("_old").select(*[_q(k) for k in keys], "occurrence", F.col("_row").alias("_l"))
    new = with_key.filter("NOT _old").select(*[_q(k) for k in keys], "occurrence", F.col("_row").alias("_r"))
    paired = old.join(new, [*keys, "occurrence"], "full_outer")
    # a NULL key is common to many rows that have nothing else in common; they need no number
    lost = copies.filter(~keyed).select(*[_q(k) for k in keys], F.lit(None).cast("int").alias("occurrence"), "_old", F.struct(*[_q(c) for c in cols]).alias("_row"))
    lost = lost.select(*[_q(k) for k in keys], "occurrence", F.when(F.col("_old"), F.col("_row")).alias("_l"), F.when(~F.col("_old"), F.col("_row")).alias("_r"))
    whole = paired.unionByName(lost)
    change = F.when(F.col("_l").isNull(), "added").when(F.col("_r").isNull(), "removed").otherwise("changed")

    def entry(c: str):
        l, r = F.col("_l")[c], F.col("_r")[c]
        return F.struct(F.lit(c).alias("column"), l.cast("string").alias("old"), r.cast("string").alias("new"), (~l.eqNullSafe(r)).alias("diff"))

    long = whole.select(*[_q(k) for k in keys], "occurrence", change.alias("change"), F.explode(F.array(*map(entry, cols))).alias("e"))
    long = long.filter((F.col("change") != "changed") | F.col("e.diff"))
    return long.select(*[_q(k) for k in keys], "occurrence", "e.column", "e.old", "e.new", "change")


def _without_equal_rows(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two stored releases without the rows that both hold equally often, by their hashes; taking equal rows from both
    leaves the difference as it is.  The hashes that are left are sent to the wide rows, which are not shuffled; if they are too
    many to send at once, some buckets' at a time."""
    if sorted(a.dtypes) != sorted(b.dtypes) or not {*HASHES} <= {*a.columns}:
        return a, b
    sign = lambda df, n: df.select(BUCKET, *HASHES, F.lit(n).alias("_n"))
    left = sign(a, 1).unionByName(sign(b, -1)).groupBy(BUCKET, *HASHES).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    left = cut_lineage(left.select(BUCKET, HASHES[0]).distinct())
    held = {r[BUCKET]: r["count"] for r in left.groupBy(BUCKET).count().collect()}
    batches = [[]]
    for bucket in sorted(held):
        if batches[-1] and sum(held[x] for x in batches[-1]) + held[bucket] > SMALL:
            batches.append([])
        batches[-1].append(bucket)

    def kept(df: DataFrame, buckets: list[int]) -> DataFrame:
        here = F.col(BUCKET).isin(buckets)
        return df.filter(here).join(F.broadcast(left.filter(here).select(HASHES[0])), HASHES[0], "left_semi")

    if len(batches) == 1:
        return kept(a, batches[0]), kept(b, batches[0])
    return tuple(reduce(DataFrame.unionByName, [cut_lineage(kept(df, buckets)) for buckets in batches]) for df in (a, b))


def diff_snapshots(spark: SparkSession, a: str, b: str, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """``diff_rows`` of the buckets that differ."""
    differ = F.col(BUCKET).isin(unequal_buckets(spark, a, b))
    return diff_rows(*_without_equal_rows(spark.read.parquet(a).filter(differ), spark.read.parquet(b).filter(differ)), keys, cols)
