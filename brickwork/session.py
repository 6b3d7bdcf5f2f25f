"""Session helpers: a local session for tests/bench and lineage cutting.

Library code never builds its own session; it works on whatever session
the caller owns.  ``local_session`` is only for tests and ``bench.py``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "brickwork") -> SparkSession:
    """A local session sized for the test box (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting a scratch one only
    when the cluster named none (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    scratch = tempfile.mkdtemp(prefix="brickwork-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once under the shared checkpoint directory and read back.

    Used once per plan where a costly intermediate (fuzzy-match candidates)
    feeds several consumers.  It is a Parquet table: compressed, its size known
    to the planner, and a consumer reads only the columns it needs.  If no
    checkpoint directory is configured the frame is returned unchanged:
    correctness never depends on the cut, and lineage recomputation still
    survives lost executors.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() or df.sparkSession.conf.get("spark.checkpoint.dir", None):
        return written(df)
    return df


def written(df: DataFrame) -> DataFrame:
    """``df`` written and read back whatever is configured, for rows that are given numbers which must not change; without
    a checkpoint directory it goes to the warehouse, which executors share as well."""
    spark = df.sparkSession
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = scratch_path(spark, "cut") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that every executor may be sent.
SMALL = 1_000_000


#: Rows with a text that every executor may be sent.
SMALL_TEXTS = 100_000


def small_side(df: DataFrame, most: int = SMALL) -> DataFrame:
    """``df`` (written rows of a few numbers) marked for broadcast if it is counted to hold at most ``most`` rows;
    otherwise the join shuffles."""
    return F.broadcast(df) if df.count() <= most else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked for a join that shuffles both sides, for tables that grow with the input.

    Left to itself, Spark goes by the size of the files or of the shuffled blocks.  Both are compressed: below the broadcast
    threshold there can be millions of rows, which the driver would gather and hash, several such tables at a time."""
    return df.hint("merge")


#: Bytes that a file may hold back in memory where a task writes many files at once.
OPEN_FILE = 4 * 2**20


@contextmanager
def unsorted_writes(spark: SparkSession, writers: int) -> Iterator[None]:
    """Partitioned writes inside keep up to ``writers`` files open in a task instead of sorting (and spilling) its rows by
    partition; a task that meets more partitions sorts the rest.  The session's own setting comes back after."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(writers, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint directory, for tables that a query writes on its way."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
