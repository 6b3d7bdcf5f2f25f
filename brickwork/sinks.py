"""Sinks (K1-K6): table materialisation, CSV exports, numeric-key export.

Writes are distributed (one file per partition); a single output file is an
explicit opt-in (``single_file=True``) because it funnels the data through
one task.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.ordering import in_order
from .session import OPEN_FILE, unsorted_writes


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None, order: list | None = None) -> None:
    """Full-refresh table (parquet), optionally directory-partitioned or in a total order over its files (O1-O3)."""
    w = (in_order(df, order) if order else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None, sort: bool = True) -> DataFrame:
    """A table in buckets of its keys, each sorted by them and in one file (K1), and the table read back.  Tables with
    the same buckets join on their keys without an exchange, as often as they are read.

    ``sort=False`` is for wide rows: each task adds its rows to files of its own, one a bucket, so whole rows are neither
    shuffled nor sorted; a join sorts the columns that it reads."""
    rows = df.repartition(buckets, *keys) if sort else df
    writer = rows.write.mode("overwrite").bucketBy(buckets, *keys).format("parquet")
    if sort:
        writer = writer.sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    else:
        writer = writer.option("parquet.block.size", OPEN_FILE)
    with nullcontext() if sort else unsorted_writes(df.sparkSession, buckets):
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_keyed(df: DataFrame, path: str, key: str, rows_per_group: int = 100_000) -> None:
    """A table laid out for lookups by ``key`` (F8, F9): in order of the key over files and row groups, so their
    least and greatest keys exclude most, and with Bloom filters of the key for values in between."""
    ordered = in_order(df, [key])
    options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.row.count.limit": str(rows_per_group)}
    ordered.write.mode("overwrite").options(**options).parquet(path)


def lookup(table: DataFrame, key: str, *values) -> DataFrame:
    """The rows of some keys (F8); the filter reaches the scan."""
    return table.filter(F.col(key).isin(*values) if len(values) > 1 else F.col(key) == F.lit(values[0]))


def open_range(table: DataFrame, key: str, above, below) -> DataFrame:
    """The rows with a key strictly between two values."""
    return table.filter((F.col(key) > F.lit(above)) & (F.col(key) < F.lit(below)))


def write_csv(df: DataFrame, path: str, single_file: bool = False, order: list | None = None) -> None:
    """CSV with header, in a total order over its files if ``order`` is given; ``single_file`` uses one task (opt-in)."""
    out = in_order(df, order, 1 if single_file else None) if order else df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def numeric_key(df: DataFrame, key: str) -> DataFrame:
    """Drop NULL keys, then text -> double -> 64-bit integer (spreadsheet export)."""
    return df.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("double").cast("bigint"))


def export_name(mart: str, user: str | None = None, now: _dt.datetime | None = None) -> str:
    """``<mart>_[user_]<YYYY-mm-dd_HHMMSS>`` export name."""
    ts = (now or _dt.datetime.now()).strftime("%Y-%m-%d_%H%M%S")
    return f"{mart}_{user + '_' if user else ''}{ts}"


def export(df: DataFrame, base: str, mart: str, user: str | None = None, write: bool = True, single_file: bool = False, order: list | None = None) -> DataFrame:
    """Mart export to ``{base}/{name}`` (any Hadoop URI, e.g. an object
    store); ``write=False`` is the skip switch and only passes through."""
    if write:
        write_csv(df, f"{base.rstrip('/')}/{export_name(mart, user)}", single_file=single_file, order=order)
    return df


def write_jdbc(df: DataFrame, url: str, table: str, props: dict, batchsize: int = 1000) -> None:
    """Replace-load a database table in batches."""
    df.write.mode("overwrite").option("batchsize", batchsize).jdbc(url, table, properties=props)
