"""Recommendation segments (S5, S6, S9, U4, M8): the request plan against what landed, and one consolidated table.

A download is a zip at ``<landing>/authority=<code>/year=<yyyy>/month=<m>/band=<band>/<name>-<offset>.zip``, a page of
at most ``page_size`` rows from an offset.  ``landed`` opens every zip once, on the executors, and counts its rows;
``reconcile`` holds the plan against these counts; ``consolidate`` reads all zips in one job.

A segment is ``missing`` (nothing landed), ``empty`` (its pages hold no rows: a zip without the file means "no data"),
``gapped`` (an offset before its last one is missing, or a page that is not the last is short), ``open`` (its last page
is full, so more is to come), or ``complete``; pages landed more than once are counted besides, and a segment whose
rows reach the service's limit is ``capped``.  Zips of segments that nobody planned are ``unplanned``.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import in_order
from .pages import RECOMMENDATION_FILE, RECOMMENDATION_SCHEMA, read_recommendation_zips

SEGMENT = ["authority", "year", "month", "band"]
LANDED = "path string, authority string, year int, month int, band string, offset long, rows long"
_PLACE = r"authority=([^/]+)/year=(\d+)/month=(\d+)/band=([^/]+)/[^/]*?(\d+)\.zip$"


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for content in frame["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                n = 0
                if RECOMMENDATION_FILE in z.namelist():
                    with z.open(RECOMMENDATION_FILE) as f:
                        n = sum(len(chunk) for chunk in pd.read_csv(f, dtype=str, chunksize=50_000, usecols=[0]))
                rows.append(n)
        yield frame.drop(columns="content").assign(rows=rows)


def landed(spark: SparkSession, path: str) -> DataFrame:
    """One row a zip: its segment, offset and number of rows."""
    options = {"pathGlobFilter": "*.zip", "recursiveFileLookup": "true"}
    files = spark.read.format("binaryFile").options(**options).load(path).select("path", "content")
    part = lambda i: F.regexp_extract("path", _PLACE, i)
    placed = files.select(
        "path", part(1).alias("authority"), part(2).cast("int").alias("year"), part(3).cast("int").alias("month"), part(4).alias("band"), part(5).cast("long").alias("offset"), "content"
    )
    return placed.mapInPandas(_count, LANDED)


def reconcile(plan: DataFrame, zips: DataFrame, page_size: int = 1000, warn_rows: int = 10_000) -> DataFrame:
    """``(*SEGMENT, status, pages, rows, landed_again, capped)``, a row for every segment planned or landed."""
    once = zips.groupBy(*SEGMENT, "offset").agg(F.max("rows").alias("rows"), F.count(F.lit(1)).alias("n"))
    held = once.groupBy(*SEGMENT).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("rows").alias("rows"),
        F.sum(F.col("n") - 1).alias("landed_again"),
        F.max("offset").alias("_last"),
        F.max_by("rows", "offset").alias("_last_rows"),
        F.count_if(F.col("rows") < page_size).alias("_short"),
    )
    either = plan.select(*SEGMENT, F.lit(True).alias("_planned")).distinct().join(held, SEGMENT, "full_outer")
    last_short = (F.col("_last_rows") < page_size).cast("long")
    gaps = (F.col("_last") / page_size + 1 > F.col("pages")) | (F.col("_short") > last_short)
    status = (
        F.when(F.col("_planned").isNull(), "unplanned")
        .when(F.col("pages").isNull(), "missing")
        .when(F.col("rows") == 0, "empty")
        .when(gaps, "gapped")
        .when(F.col("_last_rows") >= page_size, "open")
        .otherwise("complete")
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("pages", "rows", "landed_again")}
    return either.withColumn("status", status).withColumns(zero).withColumn("capped", F.col("rows") >= warn_rows).select(*SEGMENT, "status", "pages", "rows", "landed_again", "capped")


def consolidate(spark: SparkSession, path: str, order: Sequence[str] = ("LMK_KEY", "IMPROVEMENT_ITEM")) -> DataFrame:
    """All rows of all zips, in one read, each row once, in a total order over the result's partitions (A1, O3)."""
    names = [f.name for f in RECOMMENDATION_SCHEMA.fields]
    rows = read_recommendation_zips(spark, path, recursive=True).select(*names).dropDuplicates()
    return in_order(rows, [*order, *(n for n in names if n not in order)])
