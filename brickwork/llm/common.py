"""Helpers shared by the training-data operators: reading, shared storage, key runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def drop_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Rows of whole texts that go to a Python worker at once, where several operators share an executor's memory.
TEXTS = 1_000


@contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs inside hand Python workers ``rows`` rows at a time; the session's own setting comes back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows:
        spark.conf.set(key, str(min(rows, int(before) if int(before) > 0 else rows)))
    try:
        yield
    finally:
        if rows:
            spark.conf.set(key, before)


class Stage:
    """A written intermediate table: cuts lineage, survives lost executors, can be dropped early."""

    def __init__(self, df: DataFrame, name: str, partition_by: str | None = None, batch: int | None = None):
        """``batch``: rows that go to a Python worker at once while this table is written."""
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        with batches_of(self.spark, batch):
            writer.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)


_held: dict = {}


def give_back() -> None:
    """What this Python worker no longer uses goes back to the system: workers outlive stages, and allocators keep
    what was freed, so the memory of one stage would lie beside the next one's."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        pass


def tidied(batches: Iterator) -> Iterator:
    """The same batches; memory is given back after the last one."""
    yield from batches
    give_back()


def remembered(key, make):
    """What ``make`` returns, kept by a Python worker until an operator asks for something else."""
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
    return _held[key]


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with as many underscores in front as keep it from clashing."""
    taken = {c.lower() for c in taken}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_side(df: DataFrame, rows: int = 2_000_000) -> DataFrame:
    """``df`` (a written table of narrow rows) marked for broadcast if it is counted to hold at most
    ``rows`` rows; otherwise unchanged, and the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def key_runs(frames: Iterator, keys: list[str], least: int = 50_000) -> Iterator:
    """Pandas frames sorted by ``keys`` in, frames of at least ``least`` rows out, never cutting a run of equal keys."""
    import pandas as pd

    held: list = []
    n = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        n += len(frame)
        if n < least:
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        last = (whole[keys] == whole[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(whole) if not last.any() else len(whole) - int(last[::-1].cumprod().sum())
        if cut:
            yield whole.iloc[:cut]
        held, n = [whole.iloc[cut:].reset_index(drop=True)], len(whole) - cut
    if n:
        yield pd.concat(held, ignore_index=True)
