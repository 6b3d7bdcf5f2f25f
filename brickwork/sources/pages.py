"""Landed API pages and extracts.

Pages are read straight from the landing folder with a declared schema (no
inference) and exploded on the executors; nothing is collected.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# envelope paths: certificates {"rows": [...]}, addresses {"results": [{"DPA": {...}}]}
ROWS, RESULTS = "rows", "results"


def string_schema(names) -> T.StructType:
    """All-text record schema (every certificate API field is a string)."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def rows_envelope(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(ROWS, T.ArrayType(record))])


def results_envelope(record: T.StructType, feed: str) -> T.StructType:
    return T.StructType([T.StructField(RESULTS, T.ArrayType(T.StructType([T.StructField(feed, record)])))])


JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def explode_rows(pages: DataFrame, page_col: str, record: T.StructType, options: dict | None = None) -> DataFrame:
    """JSON text pages ``{"rows":[...]}`` -> one row per record."""
    parsed = pages.select(F.from_json(page_col, rows_envelope(record), {**JSON_OPTIONS, **(options or {})}).alias("p"))
    return parsed.select(F.explode(f"p.{ROWS}").alias("r")).select("r.*")


def explode_results(pages: DataFrame, page_col: str, record: T.StructType, feed: str) -> DataFrame:
    """JSON text pages ``{"results":[{"DPA":{...}}]}`` -> records."""
    parsed = pages.select(F.from_json(page_col, results_envelope(record, feed)).alias("p"))
    return parsed.select(F.explode(f"p.{RESULTS}").alias("r")).select(f"r.{feed}.*")


def read_row_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Landed page files (one JSON document per file) -> records."""
    raw = spark.read.schema(rows_envelope(record)).json(path, multiLine=True)
    return raw.select(F.explode(ROWS).alias("r")).select("r.*")


def read_result_pages(spark: SparkSession, path: str, record: T.StructType, feed: str) -> DataFrame:
    raw = spark.read.schema(results_envelope(record, feed)).json(path, multiLine=True)
    return raw.select(F.explode(RESULTS).alias("r")).select(f"r.{feed}.*")


def read_csv_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV extract with a declared schema (S11/S12); any Hadoop path/URI."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="", quote='"', escape='"', multiLine=True)


# ---- recommendation segments (S5) ---------------------------------------------
RECOMMENDATION_FILE = "recommendations.csv"
RECOMMENDATION_SCHEMA = T.StructType(
    [
        T.StructField("LMK_KEY", T.StringType()),
        T.StructField("IMPROVEMENT_ITEM", T.DoubleType()),
        T.StructField("IMPROVEMENT_SUMMARY_TEXT", T.StringType()),
        T.StructField("IMPROVEMENT_DESCR_TEXT", T.StringType()),
        T.StructField("IMPROVEMENT_ID", T.DoubleType()),
        T.StructField("IMPROVEMENT_ID_TEXT", T.StringType()),
        T.StructField("INDICATIVE_COST", T.StringType()),
    ]
)


def _unzip_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [f.name for f in RECOMMENDATION_SCHEMA.fields]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                if RECOMMENDATION_FILE not in z.namelist():
                    continue  # a segment without the file means "no data"
                with z.open(RECOMMENDATION_FILE) as f:
                    # pandas' default missing-value markers, as the extract used
                    for chunk in pd.read_csv(f, dtype=str, chunksize=50_000):
                        out = chunk.reindex(columns=cols)
                        for c in ("IMPROVEMENT_ITEM", "IMPROVEMENT_ID"):
                            out[c] = pd.to_numeric(out[c], errors="coerce")
                        out = out.astype(object).where(out.notna(), None)
                        yield out.assign(source_path=path)


def read_recommendation_zips(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Zipped segment downloads -> recommendation rows.  Zip is not a Hadoop
    codec, so each file is unpacked by ``mapInPandas`` on an executor (one
    file per task batch, streamed in chunks)."""
    options = {"pathGlobFilter": "*.zip", "recursiveFileLookup": str(recursive).lower()}
    files = spark.read.format("binaryFile").options(**options).load(path).select("path", "content")
    schema = T.StructType(RECOMMENDATION_SCHEMA.fields + [T.StructField("source_path", T.StringType())])
    return files.mapInPandas(_unzip_batches, schema)


# ---- extract segmentation and page audit (S6, S8, S9) -------------------------


def segment_plan(authorities: DataFrame, start_year: int, end_year: int, bands: list[str]) -> DataFrame:
    """Authority x year x month x band request plan, generated per authority
    row with ``explode(sequence(...))`` (no joins, no driver loops)."""
    return (
        authorities.withColumn("year", F.explode(F.sequence(F.lit(start_year), F.lit(end_year))))
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .withColumn("band", F.explode(F.array(*[F.lit(b) for b in bands])))
    )


def page_audit(pages: DataFrame, segment_cols, offset_col: str, rows_col: str, page_size: int = 1000, warn_rows: int = 10_000) -> DataFrame:
    """Per segment: distinct pages, their rows, last offset, pages landed again,
    offsets missing before the last, short pages that are not the last,
    whether either leaves a gap, and whether the segment reached the warning
    size.  A page landed more than once counts with its largest landing."""
    once = pages.groupBy(*segment_cols, offset_col).agg(F.max(rows_col).alias("_rows"), F.count(F.lit(1)).alias("_landed"))
    short = F.count_if(F.col("_rows") < page_size)
    last_short = F.max_by("_rows", offset_col) < page_size
    agg = once.groupBy(*segment_cols).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("_rows").alias("rows"),
        F.max(offset_col).alias("last_offset"),
        F.sum(F.col("_landed") - 1).alias("landed_again"),
        (short - last_short.cast("long")).alias("short_inside"),
    )
    missing = F.floor(F.col("last_offset") / page_size) + 1 - F.col("pages")
    agg = agg.withColumn("missing", missing)
    return agg.withColumns({"gapped": (F.col("missing") > 0) | (F.col("short_inside") > 0), "capped": F.col("rows") >= F.lit(warn_rows)})


def missing_offsets(pages: DataFrame, segment_cols, offset_col: str, page_size: int = 1000) -> DataFrame:
    """The offsets before a segment's last one at which no page landed."""
    last = pages.groupBy(*segment_cols).agg(F.max(offset_col).alias("_last"))
    due = last.select(*segment_cols, F.explode(F.sequence(F.lit(0), F.col("_last").cast("long"), F.lit(page_size))).alias(offset_col))
    return due.join(pages.select(*segment_cols, offset_col), [*segment_cols, offset_col], "left_anti")
