"""Incremental certificate sync (T1) with Structured Streaming.

Landed page files are picked up once each by the file source (its checkpoint
is the cursor); every micro-batch is exploded and written to a directory of
its own, which a repeated batch overwrites, so a failure between write and
commit leaves nothing twice.  ``availableNow`` processes what has landed and
stops, so the same job serves as a scheduled batch.

``sync_slices`` is the sliced form: landed files only tell which year slices
changed, and these are loaded again as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import slices
from ..sources.pages import ROWS, rows_envelope


def page_stream(spark: SparkSession, landing: str, record: T.StructType) -> DataFrame:
    raw = spark.readStream.schema(rows_envelope(record)).option("multiLine", True).json(landing)
    return raw.select(F.explode(ROWS).alias("r")).select("r.*", F.current_timestamp().alias("_loaded_at"))


def write_batch(batch: DataFrame, batch_id: int, target: str) -> None:
    """One directory per batch id: writing a batch again replaces it."""
    batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def sync_pages(spark: SparkSession, landing: str, record: T.StructType, target: str, checkpoint: str):
    """Add newly landed pages to ``target`` (parquet by ``batch_id``); returns the query."""
    stream = page_stream(spark, landing, record)

    def put(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, target)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sync_slices(spark: SparkSession, landing: str, record: T.StructType, target: str, checkpoint: str, last_year: int, page_per_file: bool = True):
    """Load the slices in which pages landed since the last run (``sources.slices``); returns the query.

    A batch replaces its slices, so a repeated batch changes nothing.  The stream reads partition columns only."""

    def put(batch: DataFrame, batch_id: int) -> None:
        touched = batch.distinct().withColumn("open", F.col("year") >= last_year)
        slices.load_slices(batch.sparkSession, landing, record, target, touched, page_per_file)

    schema = T.StructType([*rows_envelope(record).fields, *slices.SLICE_SCHEMA.fields])
    landed = spark.readStream.schema(schema).option("multiLine", page_per_file).json(landing).select(*slices.SLICE)
    return landed.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
