"""Partitioned landing and year slices (S7, S8): which slices are due, loading them, reading them pruned.

An extract is partitioned by a list (authorities) and sliced by year, from a first year to now.  Pages land in
``<landing>/authority=<code>/year=<yyyy>/``; the loaded table has the same partitions.  Beside it, a *ledger*
(``<target>/_ledger``) has one row for each load of a slice.  The cursor is the ledger: a slice is due until it was
loaded after its year had ended, so a run loads new slices and the years still open, nothing else.

Loading a slice replaces it (dynamic partition overwrite) and only then enters the ledger.  A run that dies in
between leaves the slice due, and the next run writes the same partition again.  A slice whose landing is empty
loses its partition and has a row of 0 records.

Defined cases: partitions that are not in the plan are left alone; a slice without a landing folder is loaded as empty;
a page landed twice gives its records twice (staging's UNION removes them, ``page_audit`` reports it).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import OPEN_FILE, unsorted_writes
from .pages import ROWS, rows_envelope

SLICE = ["authority", "year"]
#: Names the load that wrote a record, so that a partition left from an earlier load is told apart.
LOAD = "_load"
SLICE_SCHEMA = T.StructType([T.StructField("authority", T.StringType()), T.StructField("year", T.IntegerType())])
LEDGER_SCHEMA = T.StructType(
    [*SLICE_SCHEMA.fields, T.StructField("rows", T.LongType()), T.StructField("open", T.BooleanType()), T.StructField("loaded_at", T.TimestampType())]
)


def slice_plan(spark: SparkSession, authorities: Sequence[str], first_year: int, last_year: int) -> DataFrame:
    """Every slice of the extract; ``open`` while its year is the last one."""
    listed = spark.createDataFrame([(a,) for a in authorities], "authority string")
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    return listed.select("authority", years.alias("year")).withColumn("open", F.col("year") >= last_year)


def ledger_path(target: str) -> str:
    return f"{target.rstrip('/')}/_ledger"


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """The last load of every slice; empty before the first one."""
    try:
        loads = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path(target))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        loads = spark.createDataFrame([], LEDGER_SCHEMA)
    return loads.groupBy(*SLICE).agg(F.max_by(F.struct("rows", "open", "loaded_at"), "loaded_at").alias("l")).select(*SLICE, "l.*")


def due_slices(plan: DataFrame, loaded: DataFrame) -> DataFrame:
    """The slices of the plan that were never loaded, or loaded while their year was open."""
    return plan.join(loaded.filter(~F.col("open")).select(*SLICE), SLICE, "left_anti")


def in_slices(slices: Iterable[tuple[str, int]]) -> Column:
    """A predicate on the partition columns, which the file index evaluates before any file is opened."""
    years: dict[str, list[int]] = {}
    for authority, year in slices:
        years.setdefault(authority, []).append(year)
    wanted = [(F.col("authority") == a) & F.col("year").isin(sorted(ys)) for a, ys in sorted(years.items())]
    return reduce(or_, wanted, F.lit(False))


def landed_records(spark: SparkSession, landing: str, record: T.StructType, slices: Iterable[tuple[str, int]], page_per_file: bool = True) -> DataFrame:
    """Records of the landed pages of some slices, with the partition columns; other folders are not opened."""
    schema = T.StructType([*rows_envelope(record).fields, *SLICE_SCHEMA.fields])
    pages = spark.read.schema(schema).json(landing, multiLine=page_per_file).filter(in_slices(slices))
    return pages.select(F.explode(ROWS).alias("r"), *SLICE).select("r.*", *SLICE)


def _drop_partition(spark: SparkSession, target: str, authority: str, year: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/authority={authority}/year={year}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _table(spark: SparkSession, target: str, record: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*record.fields, T.StructField(LOAD, T.StringType()), *SLICE_SCHEMA.fields])).parquet(target)


def load_slices(spark: SparkSession, landing: str, record: T.StructType, target: str, due: DataFrame, page_per_file: bool = True) -> DataFrame:
    """Loads (or loads again) the slices in ``due`` (authority, year, open) and returns their new ledger rows.

    The slices are as many as the parameters name, not as the data grows, so they are listed on the driver, as
    their folders are.  The tasks that parse the pages write their records to the slices, without a shuffle of whole rows."""
    wanted = [(r.authority, r.year, r.open) for r in due.select(*SLICE, "open").collect()]
    entered = T.StructType(LEDGER_SCHEMA.fields[:-1])
    if not wanted:
        return spark.createDataFrame([], entered).withColumn("loaded_at", F.current_timestamp())
    slices = [(a, y) for a, y, _ in wanted]
    load = uuid.uuid4().hex
    records = landed_records(spark, landing, record, slices, page_per_file).withColumn(LOAD, F.lit(load))
    with unsorted_writes(spark, min(32, len(slices))):
        writer = records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", OPEN_FILE)
        writer.partitionBy(*SLICE).parquet(target)
    held = _table(spark, target, record).filter(in_slices(slices)).groupBy(*SLICE, LOAD).count().collect()
    counts = {(r.authority, r.year): r["count"] for r in held if r[LOAD] == load}
    for r in held:
        if (r.authority, r.year) not in counts:  # of an earlier load: nothing landed this time
            _drop_partition(spark, target, r.authority, r.year)
    rows = [(a, y, counts.get((a, y), 0), is_open) for a, y, is_open in wanted]
    loads = spark.createDataFrame(rows, entered).withColumn("loaded_at", F.current_timestamp())
    loads.coalesce(1).write.mode("append").parquet(ledger_path(target))
    return loads


def sync(spark: SparkSession, landing: str, record: T.StructType, target: str, plan: DataFrame, page_per_file: bool = True) -> DataFrame:
    """One scheduled run: loads what is due and returns its ledger rows."""
    return load_slices(spark, landing, record, target, due_slices(plan, ledger(spark, target)), page_per_file)


def read_slices(spark: SparkSession, target: str, record: T.StructType, authorities: Sequence[str] | None = None, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """The loaded table, or the slices named; the filters are on partition columns, so other folders are not read."""
    table = _table(spark, target, record).drop(LOAD)
    if authorities is not None:
        table = table.filter(F.col("authority").isin(list(authorities)))
    if first_year is not None:
        table = table.filter(F.col("year") >= first_year)
    if last_year is not None:
        table = table.filter(F.col("year") <= last_year)
    return table
